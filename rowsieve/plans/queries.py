"""Registered queries, each beside the SQL an independent engine answers it with.

A query takes ``(spark, sf_dir)`` and reads whole tables. Round trips write under the
session's shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.functions import column, literal_rows, share_of
from rowsieve.operators import (
    ApproxDistinct,
    Check,
    Completeness,
    Containment,
    Maximum,
    Mean,
    Minimum,
    Size,
    StandardDeviation,
    Uniqueness,
    Verification,
    compute_metrics,
    enrich,
    exact_quantiles,
    histograms,
    low_cardinality_columns,
    preview,
    profile_columns,
    profile_table,
    profile_wide,
    unmatched,
    verify,
)
from rowsieve.operators.enrich import MATCHED
from rowsieve.operators.metrics import frequencies
from rowsieve.operators.rules import FAILED, IS_VALID, RowSchema
from rowsieve.plans.dirty_orders import (
    COLUMNS,
    RAW_SQL,
    TESTS_SQL,
    TYPED_SQL,
    flag_name,
    flagged_sql,
    order_rules,
    orders_raw,
)
from rowsieve.plans.jobs import (
    published_gate,
    run_gate,
    run_profile,
    run_published_gate,
    run_verification,
)
from rowsieve.sources import (
    ResultKey,
    append_metrics,
    compact_history,
    fresh_path,
    integer_range,
    read_delimited,
    read_history,
    read_run_metrics,
    run_metrics,
    success_metrics,
    write_invalid_csv,
    write_valid_csv,
    write_valid_orc,
)
from rowsieve.sources.history import with_key

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str, *, name: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[name or query.__name__] = query
        ORACLES[name or query.__name__] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without_zone(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


# --- row-level schema -------------------------------------------------------------

_FAILED_SQL = ", ".join(
    f"CASE WHEN NOT {flag_name(key)} THEN '{key}' END" for key in TESTS_SQL
)


@registered(
    f"SELECT *, concat_ws('|', {_FAILED_SQL}) AS failed FROM ({flagged_sql()}) flagged"
)
def row_gate_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = order_rules()
    flagged = rules.flag(orders_raw(spark, sf_dir))
    tests = [test.alias(flag_name(key)) for key, test in rules.tests().items()]
    return flagged.select(
        *orders_raw(spark, sf_dir).columns,
        *tests,
        F.col(IS_VALID).alias("is_valid"),
        F.concat_ws("|", FAILED).alias("failed"),
    )


@registered(f"SELECT {TYPED_SQL} FROM ({flagged_sql()}) flagged WHERE is_valid")
def row_gate_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_zone(order_rules().split(orders_raw(spark, sf_dir)).valid, "order_date")


@registered(
    "SELECT order_id, cust_id, status, priority_code, order_date"
    f" FROM ({flagged_sql()}) flagged WHERE NOT is_valid"
)
def row_gate_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_rules().split(orders_raw(spark, sf_dir)).invalid


_COUNTS_SQL = (
    "SELECT count(*) FILTER (WHERE is_valid) AS num_valid_rows,"
    " count(*) FILTER (WHERE NOT is_valid) AS num_invalid_rows FROM ({}) flagged"
)


@registered(_COUNTS_SQL.format(flagged_sql()))
def row_gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_rules().counts(orders_raw(spark, sf_dir))


@registered(_COUNTS_SQL.format(flagged_sql(full_match=True)))
def row_gate_full_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_rules(full_match=True).counts(orders_raw(spark, sf_dir))


@registered(
    " UNION ALL ".join(
        f"SELECT '{key}' AS test, count(*) FILTER (WHERE NOT {flag_name(key)}) AS num_failed"
        f" FROM ({flagged_sql()}) flagged"
        for key in TESTS_SQL
    )
)
def row_gate_failure_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_rules().failure_counts(orders_raw(spark, sf_dir))


@registered(
    """SELECT l_orderkey, l_linenumber, CAST(part_count AS INTEGER) AS part_count FROM (
        SELECT *, l_quantity + CASE WHEN l_orderkey % 3 = 0 THEN 0.5 ELSE 0 END AS part_count
        FROM lineitem) WHERE part_count = floor(part_count)"""
)
def row_gate_typed_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An integer rule over a column of doubles, some of which have fractions."""
    half = F.when(F.col("l_orderkey") % 3 == 0, 0.5).otherwise(0.0)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") + half).alias("part_count")
    )
    rules = RowSchema().int_column("part_count", is_nullable=False)
    valid = rules.split(lines).valid
    return valid.select("l_orderkey", "l_linenumber", "part_count")


# --- lookup enrichment ------------------------------------------------------------


@registered(
    "SELECT customer.*, nation.n_name FROM customer JOIN nation ON c_nationkey = n_nationkey"
)
def lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return enrich(customer, nation, {"c_nationkey": "n_nationkey"}, ["n_name"])


@registered(
    f"""SELECT raw.*, c_name FROM ({RAW_SQL}) raw JOIN customer
    ON c_custkey = CASE WHEN regexp_full_match(cust_id, '[+-]?\\d+') THEN TRY_CAST(cust_id AS BIGINT) END"""
)
def lookup_join_text_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text keys, faults among them, against the customers' typed key."""
    customer = table(spark, sf_dir, "customer")
    return enrich(orders_raw(spark, sf_dir), customer, {"cust_id": "c_custkey"}, ["c_name"])


# A status lookup that lacks P, so that enrichment loses rows.
STATUS_LOOKUP = [("O", "open"), ("F", "finished")]
_LOOKUP_SQL = "(VALUES ('O', 'open'), ('F', 'finished')) lookup(code, description)"
_ENRICHED_SQL = f"SELECT raw.*, description FROM ({RAW_SQL}) raw JOIN {_LOOKUP_SQL} ON status = code"


def status_lookup(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, STATUS_LOOKUP, {"code": "string", "description": "string"})


@registered(
    f"""SELECT (SELECT count(*) FROM orders) AS num_rows, count(*) AS num_enriched,
        (SELECT count(*) FROM orders) - count(*) AS num_lost,
        count(*) FILTER (WHERE is_valid) AS num_valid_rows,
        count(*) FILTER (WHERE NOT is_valid) AS num_invalid_rows
    FROM ({flagged_sql(source=_ENRICHED_SQL)}) flagged"""
)
def enriched_gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = enrich(
        orders_raw(spark, sf_dir),
        status_lookup(spark),
        {"status": "code"},
        ["description"],
        mark_unmatched=True,
    )
    rows, enriched = F.count(F.lit(1)), F.count_if(MATCHED)
    valid = F.count_if(F.col(MATCHED) & order_rules().is_valid())
    return marked.agg(
        rows.alias("num_rows"),
        enriched.alias("num_enriched"),
        (rows - enriched).alias("num_lost"),
        valid.alias("num_valid_rows"),
        (enriched - valid).alias("num_invalid_rows"),
    )


@registered(
    f"SELECT {TYPED_SQL}, description FROM ({flagged_sql(source=_ENRICHED_SQL)}) flagged"
    " WHERE is_valid"
)
def enriched_gate_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = enrich(
        orders_raw(spark, sf_dir), status_lookup(spark), {"status": "code"}, ["description"]
    )
    return without_zone(order_rules().split(enriched).valid, "order_date")


@registered(
    f"""SELECT order_id, cust_id, status, priority_code, order_date FROM ({RAW_SQL}) raw
    WHERE status IS NULL OR status NOT IN ('O', 'F')"""
)
def enrichment_lost_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmatched(orders_raw(spark, sf_dir), status_lookup(spark), {"status": "code"})


# --- sources and sinks ------------------------------------------------------------


@registered("SELECT * FROM orders")
def tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = table(spark, sf_dir, "orders"), fresh_path(spark, "orders-tsv")
    orders.write.csv(path, sep="\t", header=True)
    # Inference narrows keys to int and gives timestamps a zone.
    back = read_delimited(spark, path, infer=True)
    return back.select(*[column(f.name).cast(f.dataType).alias(f.name) for f in orders.schema])


@registered("SELECT * FROM supplier")
def lookup_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    path = fresh_path(spark, "supplier") + "/lookup_supplier,csv"
    supplier.write.csv(path, header=True)
    return read_delimited(spark, path, sep=",", schema=supplier.schema)


@registered(f"SELECT {TYPED_SQL} FROM ({flagged_sql()}) flagged WHERE is_valid")
def orc_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = order_rules().split(orders_raw(spark, sf_dir)).valid
    path = write_valid_orc(valid, fresh_path(spark, "orc"), "orders")
    return without_zone(spark.read.schema(valid.schema).orc(path), "order_date")


@registered(f"SELECT {TYPED_SQL} FROM ({flagged_sql()}) flagged WHERE is_valid")
def csv_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = order_rules().split(orders_raw(spark, sf_dir)).valid
    path = write_valid_csv(valid, fresh_path(spark, "csv"), "orders")
    back = read_delimited(spark, path, sep=",", header=False, schema=valid.schema)
    return without_zone(back, "order_date")


@registered(
    f"""SELECT order_id, cust_id, status, priority_code, order_date,
        concat_ws('|', {_FAILED_SQL}) AS failed
    FROM ({flagged_sql()}) flagged WHERE NOT is_valid"""
)
def quarantine_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    invalid = order_rules().split(orders_raw(spark, sf_dir), reasons=True).invalid
    path = write_invalid_csv(invalid, fresh_path(spark, "quarantine"), "orders")
    names = [*invalid.columns[:-1], "failed"]
    schema = ", ".join(f"{name} string" for name in names)
    return read_delimited(spark, path, sep=",", header=False, schema=schema)


@registered(
    f"""WITH n AS ({_COUNTS_SQL.format(flagged_sql())})
    SELECT 'valid_orc' AS output, num_valid_rows AS num_rows FROM n
    UNION ALL SELECT 'valid_csv', num_valid_rows FROM n
    UNION ALL SELECT 'invalid_csv', num_invalid_rows FROM n
    UNION ALL SELECT 'num_Valid_Rows_count', num_valid_rows FROM n
    UNION ALL SELECT 'num_Invalid_Rows_count', num_invalid_rows FROM n
    UNION ALL SELECT 'job_total_duration_sec', 7"""
)
def gate_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole gate job; counts what arrived in each output and its gauges."""
    done = run_gate(
        orders_raw(spark, sf_dir),
        order_rules(),
        fresh_path(spark, "gate"),
        "orders",
        dataset="orders_raw",
        start_millis=1_700_000_000_900,
        end_millis=1_700_000_007_100,
    )
    text = ", ".join(f"c{i} string" for i in range(5))
    outputs = {
        "valid_orc": spark.read.orc(done.valid_orc),
        "valid_csv": read_delimited(spark, done.valid_csv, sep=",", header=False, schema=text),
        "invalid_csv": read_delimited(spark, done.invalid_csv, sep=",", header=False, schema=text),
    }
    counts = [
        output.agg(F.count(F.lit(1)).alias("num_rows")).select(
            F.lit(name).alias("output"), "num_rows"
        )
        for name, output in outputs.items()
    ]
    gauges = done.gauges.select(
        F.col("metric").alias("output"), F.col("value").cast("bigint").alias("num_rows")
    )
    return reduce(DataFrame.unionAll, [*counts, gauges])


# What the three outputs of a gate over ``{source}`` hold, as text; dates by their day.
_TYPED_TEXT_SQL = """CAST(CAST(trim(order_id) AS INTEGER) AS VARCHAR) AS order_id,
    CAST(CAST(trim(cust_id) AS INTEGER) AS VARCHAR) AS cust_id, status, priority_code, order_date"""


def gate_contents_sql(source: str = RAW_SQL, extra: str = "") -> str:
    flagged = f"({flagged_sql(source=source)}) flagged"
    return f"""SELECT 'valid_orc' AS output, {_TYPED_TEXT_SQL}{extra}, '' AS failed FROM {flagged} WHERE is_valid
        UNION ALL SELECT 'valid_csv', {_TYPED_TEXT_SQL}{extra}, '' FROM {flagged} WHERE is_valid
        UNION ALL SELECT 'invalid_csv', order_id, cust_id, status, priority_code, order_date{extra},
            concat_ws('|', {_FAILED_SQL}) FROM {flagged} WHERE NOT is_valid"""


def gate_contents(spark: SparkSession, paths: dict[str, str], *extra: str, reasons: bool = True) -> DataFrame:
    """All rows of a gate's outputs as text, dates by their day, with the output's name."""
    names = ["order_id", "cust_id", "status", "priority_code", "order_date", *extra]
    text = ", ".join(f"{name} string" for name in names)
    invalid = text + (", failed string" if reasons else "")
    parts = {
        "valid_orc": spark.read.orc(paths["valid_orc"]).select(*names),
        "valid_csv": read_delimited(spark, paths["valid_csv"], sep=",", header=False, schema=text),
        "invalid_csv": read_delimited(spark, paths["invalid_csv"], sep=",", header=False, schema=invalid),
    }
    rows = []
    for name, part in parts.items():
        day = F.col("order_date").cast("string")
        if name != "invalid_csv":
            part = part.withColumn("order_date", F.substring(day, 1, 10))
        failed = F.col("failed") if "failed" in part.columns else F.lit("")
        texts = [F.col(x).cast("string").alias(x) for x in names]
        rows.append(part.select(F.lit(name).alias("output"), *texts, failed.alias("failed")))
    return reduce(DataFrame.unionAll, rows)


def _paths(done) -> dict[str, str]:
    return {"valid_orc": done.valid_orc, "valid_csv": done.valid_csv, "invalid_csv": done.invalid_csv}


@registered(gate_contents_sql())
def gate_from_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over a delimited file read as text, and every row of its three outputs."""
    raw, path = orders_raw(spark, sf_dir), fresh_path(spark, "raw-tsv")
    raw.write.csv(path, sep="\t", header=True)
    done = run_gate(
        read_delimited(spark, path),
        order_rules(),
        fresh_path(spark, "gate-tsv"),
        "orders",
        dataset="orders.tsv",
        reasons=True,
    )
    return gate_contents(spark, _paths(done))


@registered(gate_contents_sql(_ENRICHED_SQL, ", description"))
def enriched_gate_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over enriched rows: every row of its outputs, the quarantined ones with reasons."""
    enriched = enrich(
        orders_raw(spark, sf_dir), status_lookup(spark), {"status": "code"}, ["description"]
    )
    done = run_gate(
        enriched,
        order_rules(),
        fresh_path(spark, "gate-enriched"),
        "orders",
        dataset="orders_raw",
        reasons=True,
    )
    return gate_contents(spark, _paths(done), "description")


@registered(
    f"""SELECT order_id, cust_id, status, priority_code, order_date, description,
        concat_ws('|', {_FAILED_SQL}) AS failed
    FROM ({flagged_sql(source=_ENRICHED_SQL)}) flagged WHERE NOT is_valid"""
)
def enriched_gate_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = enrich(
        orders_raw(spark, sf_dir), status_lookup(spark), {"status": "code"}, ["description"]
    )
    invalid = order_rules().split(enriched, reasons=True).invalid
    return invalid.withColumn(FAILED, F.concat_ws("|", FAILED)).withColumnRenamed(FAILED, "failed")


_URGENT_SQL = f"SELECT * FROM ({RAW_SQL}) raw WHERE priority_code LIKE '1%'"


@registered(gate_contents_sql(_URGENT_SQL))
def gate_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two published runs of one gate, then one that breaks off: the second one's rows are current."""
    raw, out = orders_raw(spark, sf_dir), fresh_path(spark, "gate-published")
    rules = order_rules()

    def publish(df: DataFrame) -> None:
        run_published_gate(df, rules, out, "orders", dataset="orders_raw", reasons=True)

    publish(raw)
    publish(raw.where("priority_code LIKE '1%'"))
    try:
        publish(raw.where(F.assert_true(F.col("order_id").isNull()).isNull()))
    except Exception as broken:  # the third run meets a row that it must not
        if "is not true" not in str(broken):
            raise
    else:
        raise AssertionError("the third run was to break off")
    return gate_contents(spark, published_gate(spark, out, "orders"))


@registered(
    """SELECT count(*) AS num_ids, min(id) AS first_id, max(id) AS last_id,
        CAST(sum(id) AS BIGINT) AS sum_ids, count(o_orderkey) AS num_orders
    FROM (SELECT unnest(range(1, (SELECT max(o_orderkey) + 1 FROM orders))) AS id)
    LEFT JOIN orders ON id = o_orderkey"""
)
def range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range of order keys, laid over the orders that hold them."""
    keys = table(spark, sf_dir, "orders").select("o_orderkey")
    end = keys.agg(F.max("o_orderkey") + 1).first()[0]
    ids = integer_range(spark, end, spark.sparkContext.defaultParallelism)
    return ids.join(keys, F.col("id") == F.col("o_orderkey"), "left").agg(
        F.count(F.lit(1)).alias("num_ids"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.sum("id").alias("sum_ids"),
        F.count("o_orderkey").alias("num_orders"),
    )


# --- checks -----------------------------------------------------------------------


def results_sql(rows: list[tuple[str, str, str, str, str, str]], tail: str = "") -> str:
    """SQL of constraint results from (check, level, metric, instance, assertion, value SQL)."""
    parts = [
        f"""SELECT '{check}' AS "check", '{level}' AS level, '{metric}' AS metric,
            '{metric}' || CASE WHEN '{instance}' = '*' THEN '' ELSE '({instance})' END AS "constraint",
            '{instance}' AS instance, '{assertion}' AS assertion, value,
            coalesce({assertion}, FALSE) AS passed
        FROM (SELECT CAST(({value}) AS DOUBLE) AS value)"""
        for check, level, metric, instance, assertion, value in rows
    ]
    return f"""SELECT "check", level, "constraint", metric, instance, round(value, 6) AS value,
        CASE WHEN passed THEN 'Success' ELSE 'Failure' END AS status,
        CASE WHEN passed THEN ''
            WHEN value IS NULL THEN "constraint" || ' has no value: no rows'
            ELSE 'value ' || printf('%.6f', value) || ' does not meet: ' || assertion
        END AS message
    FROM ({' UNION ALL '.join(parts)}) judged{tail}"""


def complete_sql(source: str, col: str) -> str:
    return f"SELECT count({col}) / count(*) FROM {source}"


def unique_sql(source: str, *cols: str) -> str:
    keys, some = ", ".join(cols), " OR ".join(f"{col} IS NOT NULL" for col in cols)
    return f"""SELECT count(*) FILTER (WHERE n = 1) / sum(n)
        FROM (SELECT count(*) AS n FROM {source} WHERE {some} GROUP BY {keys})"""


def share_sql(source: str, predicate: str) -> str:
    return f"SELECT count(*) FILTER (WHERE {predicate}) / count(*) FROM {source}"


def contained_sql(source: str, col: str, *values: str) -> str:
    return share_sql(source, f"{col} IS NULL OR {col} IN ({', '.join(map(repr, values))})")


_RAW = f"({RAW_SQL}) raw"


def results(*runs: Verification) -> DataFrame:
    return rounded(reduce(DataFrame.unionAll, [run.results for run in runs]), "value")


@registered(
    results_sql(
        [
            ("size", "Error", "Size", "*", "value = 12", "SELECT count(*) FROM orders"),
            ("size", "Warning", "Size", "*", "value > 0", "SELECT count(*) FROM lineitem"),
        ]
    )
)
def check_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return results(
        verify(orders, [Check("Error", "size").has_size("value = 12")]),
        verify(lineitem, [Check("Warning", "size").has_size("value > 0")]),
    )


@registered(
    results_sql(
        [
            ("complete", "Error", "Completeness", col, "value = 1", complete_sql(_RAW, col))
            for col in ("order_id", "cust_id", "status")
        ]
    )
)
def check_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = Check("Error", "complete")
    for name in ("order_id", "cust_id", "status"):
        check = check.is_complete(name)
    return results(verify(orders_raw(spark, sf_dir), [check]))


@registered(
    results_sql(
        [
            ("unique", "Error", "Uniqueness", names, "value = 1", unique_sql(source, *names.split(",")))
            for source, names in [
                ("orders", "o_orderkey"),
                ("orders", "o_custkey,o_orderstatus"),
                ("lineitem", "l_orderkey,l_linenumber"),
                ("documents", "text"),
                (_RAW, "cust_id"),
                (_RAW, "order_id"),
            ]
        ]
    )
)
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = Check("Error", "unique")
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    documents, raw = table(spark, sf_dir, "documents"), orders_raw(spark, sf_dir)
    return results(
        verify(orders, [check.is_unique("o_orderkey").is_unique("o_custkey", "o_orderstatus")]),
        verify(lineitem, [check.is_unique("l_orderkey", "l_linenumber")]),
        verify(documents, [check.is_unique("text", digest=True)]),
        verify(raw, [check.is_unique("cust_id").is_unique("order_id")]),
    )


@registered(
    results_sql(
        [
            ("contained", "Error", "Compliance", "status contained in O,F,P", "value = 1",
             contained_sql(_RAW, "status", "O", "F", "P")),
            ("contained", "Error", "Compliance", "status contained in O,F,P,Z,XOX", "value = 1",
             contained_sql(_RAW, "status", "O", "F", "P", "Z", "XOX")),
            ("contained", "Warning", "Compliance", "event_type contained in click,view",
             "value >= 0.3", contained_sql("events", "event_type", "click", "view")),
        ]
    )
)
def check_contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_raw = (
        Check("Error", "contained")
        .is_contained_in("status", ["O", "F", "P"])
        .is_contained_in("status", ["O", "F", "P", "Z", "XOX"])
    )
    on_events = Check("Warning", "contained").is_contained_in(
        "event_type", ["click", "view"], "value >= 0.3"
    )
    return results(
        verify(orders_raw(spark, sf_dir), [on_raw]),
        verify(table(spark, sf_dir, "events"), [on_events]),
    )


def non_negative_text_sql(col: str) -> str:
    number = r"\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*"
    return f"""CASE WHEN regexp_full_match({col}, '{number}')
        THEN TRY_CAST(trim({col}) AS DOUBLE) >= 0 ELSE TRUE END"""


@registered(
    results_sql(
        [
            ("non-negative", "Error", "Compliance", "c_acctbal is non-negative", "value = 1",
             share_sql("customer", "c_acctbal IS NULL OR c_acctbal >= 0")),
            ("non-negative", "Error", "Compliance", "c_custkey is non-negative", "value = 1",
             share_sql("customer", "c_custkey IS NULL OR c_custkey >= 0")),
            ("non-negative", "Error", "Compliance", "order_id is non-negative", "value = 1",
             share_sql(_RAW, non_negative_text_sql("order_id"))),
        ]
    )
)
def check_non_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = Check("Error", "non-negative")
    return results(
        verify(
            table(spark, sf_dir, "customer"),
            [check.is_non_negative("c_acctbal").is_non_negative("c_custkey")],
        ),
        verify(orders_raw(spark, sf_dir), [check.is_non_negative("order_id")]),
    )


@registered(
    results_sql(
        [
            ("quantiles", "Warning", f"ApproxQuantile-{q}", col, assertion,
             f"SELECT quantile_disc({col}, {q}) FROM lineitem")
            for col, q, assertion in [
                ("l_quantity", 0.25, "value <= 11"),
                ("l_linenumber", 0.5, "value <= 11"),
                ("l_tax", 0.9, "value < 0.05"),
            ]
        ]
    )
)
def check_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = (
        Check("Warning", "quantiles")
        .has_approx_quantile("l_quantity", 0.25, "value <= 11")
        .has_approx_quantile("l_linenumber", 0.5, "value <= 11")
        .has_approx_quantile("l_tax", 0.9, "value < 0.05")
    )
    return results(verify(table(spark, sf_dir, "lineitem"), [check]))


QUANTILES = [
    ("l_quantity", 0.5),
    ("l_extendedprice", 0.5),
    ("l_extendedprice", 0.99),
    ("l_discount", 0.1),
    ("l_orderkey", 0.0),
    ("l_orderkey", 1.0),
]


@registered(
    " UNION ALL ".join(
        f"""SELECT '{col}' AS "column", CAST({q} AS DOUBLE) AS quantile,
            CAST(quantile_disc({col}, {q}) AS DOUBLE) AS value FROM lineitem"""
        for col, q in QUANTILES
    )
)
def quantile_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_quantiles(table(spark, sf_dir, "lineitem"), QUANTILES)


def _verifications(spark: SparkSession, sf_dir: str) -> list[Verification]:
    customer = [
        Check("Error", "customer rows")
        .has_size("value = 12")
        .is_complete("c_custkey")
        .is_unique("c_custkey")
        .is_complete("c_name")
        .is_contained_in("c_mktsegment", ["AUTOMOBILE", "BUILDING", "FURNITURE"])
        .is_non_negative("c_acctbal"),
        Check("Warning", "customer spread").has_approx_quantile(
            "c_nationkey", 0.75, "value <= 11"
        ),
    ]
    raw = [
        Check("Error", "raw order rows").has_size("value > 0").is_complete("order_id"),
        Check("Warning", "raw order shares")
        .is_complete("cust_id")
        .is_unique("order_id")
        .is_unique("cust_id")
        .is_contained_in("status", ["O", "F", "P"], lambda share: share >= 0.9)
        .satisfies("order_date LIKE '2015-%'", "order_date in 2015", "value < 0.01"),
    ]
    return [
        verify(table(spark, sf_dir, "customer"), customer),
        verify(orders_raw(spark, sf_dir), raw),
    ]


_REPORT_ROWS = [
    ("customer rows", "Error", "Size", "*", "value = 12", "SELECT count(*) FROM customer"),
    ("customer rows", "Error", "Completeness", "c_custkey", "value = 1",
     complete_sql("customer", "c_custkey")),
    ("customer rows", "Error", "Uniqueness", "c_custkey", "value = 1",
     unique_sql("customer", "c_custkey")),
    ("customer rows", "Error", "Completeness", "c_name", "value = 1",
     complete_sql("customer", "c_name")),
    ("customer rows", "Error", "Compliance",
     "c_mktsegment contained in AUTOMOBILE,BUILDING,FURNITURE", "value = 1",
     contained_sql("customer", "c_mktsegment", "AUTOMOBILE", "BUILDING", "FURNITURE")),
    ("customer rows", "Error", "Compliance", "c_acctbal is non-negative", "value = 1",
     share_sql("customer", "c_acctbal IS NULL OR c_acctbal >= 0")),
    ("customer spread", "Warning", "ApproxQuantile-0.75", "c_nationkey", "value <= 11",
     "SELECT quantile_disc(c_nationkey, 0.75) FROM customer"),
    ("raw order rows", "Error", "Size", "*", "value > 0", f"SELECT count(*) FROM {_RAW}"),
    ("raw order rows", "Error", "Completeness", "order_id", "value = 1",
     complete_sql(_RAW, "order_id")),
    ("raw order shares", "Warning", "Completeness", "cust_id", "value = 1",
     complete_sql(_RAW, "cust_id")),
    ("raw order shares", "Warning", "Uniqueness", "order_id", "value = 1",
     unique_sql(_RAW, "order_id")),
    ("raw order shares", "Warning", "Uniqueness", "cust_id", "value = 1",
     unique_sql(_RAW, "cust_id")),
    ("raw order shares", "Warning", "Compliance", "status contained in O,F,P", "value >= 0.9",
     contained_sql(_RAW, "status", "O", "F", "P")),
    ("raw order shares", "Warning", "Compliance", "order_date in 2015", "value < 0.01",
     share_sql(_RAW, "order_date LIKE '2015-%'")),
]


@registered(results_sql(_REPORT_ROWS))
def verification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results(*_verifications(spark, sf_dir))


@registered(
    f"""SELECT "check", level, "constraint", message
    FROM ({results_sql(_REPORT_ROWS)}) WHERE status <> 'Success'"""
)
def verification_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _verifications(spark, sf_dir)
    return reduce(DataFrame.unionAll, [run.failures() for run in runs])


_WORST_SQL = """CASE max(CASE WHEN status = 'Success' THEN 0 WHEN level = 'Error' THEN 2 ELSE 1 END)
    WHEN 2 THEN 'Error' WHEN 1 THEN 'Warning' ELSE 'Success' END"""


@registered(
    f"""WITH judged AS ({results_sql(_REPORT_ROWS)})
    SELECT "check" AS scope, level, {_WORST_SQL} AS status FROM judged GROUP BY "check", level
    UNION ALL SELECT 'run on customer', 'Run', {_WORST_SQL} FROM judged
        WHERE "check" NOT LIKE 'raw%'
    UNION ALL SELECT 'run on orders_raw', 'Run', {_WORST_SQL} FROM judged
        WHERE "check" LIKE 'raw%'"""
)
def verification_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for name, run in zip(("customer", "orders_raw"), _verifications(spark, sf_dir)):
        parts.append(run.check_status().withColumnRenamed("check", "scope"))
        parts.append(
            run.status().select(
                F.lit(f"run on {name}").alias("scope"), F.lit("Run").alias("level"), "status"
            )
        )
    return reduce(DataFrame.unionAll, parts)


# --- metrics and history ----------------------------------------------------------

ORDER_METRICS = [
    Size(),
    Completeness("o_custkey"),
    Uniqueness(("o_orderkey",)),
    Uniqueness(("o_custkey", "o_orderpriority")),
    Containment("o_orderstatus", ("O", "F")),
    Minimum("o_totalprice"),
    Maximum("o_totalprice"),
    Mean("o_totalprice"),
    StandardDeviation("o_totalprice"),
]

_ORDER_METRICS_SQL = [
    ("Dataset", "*", "Size", "SELECT count(*) FROM orders"),
    ("Column", "o_custkey", "Completeness", complete_sql("orders", "o_custkey")),
    ("Column", "o_orderkey", "Uniqueness", unique_sql("orders", "o_orderkey")),
    ("Multicolumn", "o_custkey,o_orderpriority", "Uniqueness",
     unique_sql("orders", "o_custkey", "o_orderpriority")),
    ("Column", "o_orderstatus contained in O,F", "Compliance",
     contained_sql("orders", "o_orderstatus", "O", "F")),
    ("Column", "o_totalprice", "Minimum", "SELECT min(o_totalprice) FROM orders"),
    ("Column", "o_totalprice", "Maximum", "SELECT max(o_totalprice) FROM orders"),
    ("Column", "o_totalprice", "Mean", "SELECT avg(o_totalprice) FROM orders"),
    ("Column", "o_totalprice", "StandardDeviation",
     "SELECT stddev_pop(o_totalprice) FROM orders"),
]


def metrics_sql(rows: list[tuple[str, str, str, str]], dataset_date: int, tag: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{entity}' AS entity, '{instance}' AS instance, '{name}' AS name,
            round(CAST(({value}) AS DOUBLE), 4) AS value,
            CAST({dataset_date} AS BIGINT) AS dataset_date, '{tag}' AS tag"""
        for entity, instance, name, value in rows
    )


@registered(metrics_sql(_ORDER_METRICS_SQL, 1_700_000_000_000, "demo"))
def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ResultKey(1_700_000_000_000, {"tag": "demo"})
    metrics = compute_metrics(table(spark, sf_dir, "orders"), ORDER_METRICS)
    return rounded(success_metrics(with_key(metrics, key), ["tag"]), "value", digits=4)


@registered(
    metrics_sql(_ORDER_METRICS_SQL, 1_700_000_000_000, "nightly")
    + " UNION ALL "
    + metrics_sql(
        [
            ("Dataset", "*", "Size", "SELECT count(*) FROM customer"),
            ("Column", "c_acctbal", "Mean", "SELECT avg(c_acctbal) FROM customer"),
        ],
        1_700_172_800_000,
        "nightly",
    )
)
def history_append_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four appends under three keys, one of them written twice; one tag is read back."""
    path = fresh_path(spark, "history")
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    first = ResultKey(1_700_000_000_000, {"tag": "nightly"})
    stale = compute_metrics(customer, [Size()])
    append_metrics(stale, path, first, written_at=1)
    append_metrics(compute_metrics(orders, ORDER_METRICS), path, first, written_at=2)
    append_metrics(stale, path, ResultKey(1_700_086_400_000, {"tag": "adhoc"}))
    append_metrics(
        compute_metrics(customer, [Size(), Mean("c_acctbal")]),
        path,
        ResultKey(1_700_172_800_000, {"tag": "nightly", "site": "a"}),
    )
    history = read_history(spark, path, tags={"tag": "nightly"}, first_day="2023-11-14")
    return rounded(success_metrics(history, ["tag"]), "value", digits=4)


@registered(
    f"""WITH n AS ({_COUNTS_SQL.format(flagged_sql())})
    SELECT 'orders gate' AS job, metric, help, 'orders_raw' AS dataset, value,
        CAST(1700000061500 AS BIGINT) AS ts
    FROM (
        SELECT 'num_Valid_Rows_count' AS metric, 'Num of valid rows in dataset' AS help,
            CAST(num_valid_rows AS DOUBLE) AS value FROM n
        UNION ALL SELECT 'num_Invalid_Rows_count', 'Num of invalid rows in dataset',
            CAST(num_invalid_rows AS DOUBLE) FROM n
        UNION ALL SELECT 'job_total_duration_sec', 'job duration', CAST(61 AS DOUBLE)
    )""",
    name="run_metrics",
)
def run_metrics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    gauges = run_metrics(
        order_rules().counts(orders_raw(spark, sf_dir)),
        job="orders gate",
        dataset="orders_raw",
        start_millis=1_700_000_000_400,
        end_millis=1_700_000_061_500,
    )
    return gauges.select(
        "job", "metric", "help", F.col("labels")["dataset"].alias("dataset"), "value", "ts"
    )


@registered(
    f"""WITH whole AS ({_COUNTS_SQL.format(flagged_sql())}),
        urgent AS ({_COUNTS_SQL.format(flagged_sql(source=_URGENT_SQL))}),
        runs AS (SELECT 'whole' AS job, 1700000007100 AS ts, DATE '2023-11-14' AS ds, 7 AS sec, * FROM whole
            UNION ALL SELECT 'urgent', 1700086402000, DATE '2023-11-15', 2, * FROM urgent)
    SELECT job, metric, value, CAST(ts AS BIGINT) AS ts, CAST(ds AS VARCHAR) AS day, 'orders_raw' AS dataset FROM (
        SELECT *, 'num_Valid_Rows_count' AS metric, CAST(num_valid_rows AS DOUBLE) AS value FROM runs
        UNION ALL SELECT *, 'num_Invalid_Rows_count', CAST(num_invalid_rows AS DOUBLE) FROM runs
        UNION ALL SELECT *, 'job_total_duration_sec', CAST(sec AS DOUBLE) FROM runs)"""
)
def gate_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauges that three gate runs append to a table, read back without the run of the last day."""
    raw, path = orders_raw(spark, sf_dir), fresh_path(spark, "gauges")
    urgent = raw.where("priority_code LIKE '1%'")
    runs = [
        ("whole", raw, 1_700_000_000_900, 1_700_000_007_100),
        ("urgent", urgent, 1_700_086_400_000, 1_700_086_402_000),
        ("late", urgent, 1_700_200_000_000, 1_700_200_002_000),
    ]
    for job, source, start, end in runs:
        run_gate(
            source,
            order_rules(),
            fresh_path(spark, "gate-gauges"),
            job,
            dataset="orders_raw",
            metrics_path=path,
            start_millis=start,
            end_millis=end,
        )
    stored = read_run_metrics(spark, path, first_day="2023-11-14", last_day="2023-11-16")
    labels, day = F.col("labels")["dataset"].alias("dataset"), F.col("ds").cast("string").alias("day")
    return stored.select("job", "metric", "value", "ts", day, labels)


_DAY_MILLIS = 86_400_000


def _daily_metrics_sql(first: int, last: int) -> str:
    return " UNION ALL ".join(
        metrics_sql(
            [
                ("Dataset", "*", "Size", f"SELECT count(*) FROM orders WHERE o_orderkey % 7 = {day}"),
                ("Column", "o_totalprice", "Maximum",
                 f"SELECT max(o_totalprice) FROM orders WHERE o_orderkey % 7 = {day}"),
            ],
            1_700_000_000_000 + day * _DAY_MILLIS,
            "daily",
        )
        for day in range(first, last + 1)
    )


def _append_day(spark: SparkSession, sf_dir: str, path: str, day: int) -> None:
    part = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 7 == day)
    key = ResultKey(1_700_000_000_000 + day * _DAY_MILLIS, {"tag": "daily"})
    append_metrics(compute_metrics(part, [Size(), Maximum("o_totalprice")]), path, key)


@registered(_daily_metrics_sql(2, 4))
def history_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of a week, of which the days asked for leave out those before and after."""
    path = fresh_path(spark, "history-days")
    for day in range(7):
        _append_day(spark, sf_dir, path, day)
    history = read_history(spark, path, first_day="2023-11-16", last_day="2023-11-18")
    return rounded(success_metrics(history, ["tag"]), "value", digits=4)


@registered(_daily_metrics_sql(1, 6))
def history_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs gathered in a snapshot twice, one of them written anew, and runs after it."""
    path, orders = fresh_path(spark, "history-compacted"), table(spark, sf_dir, "orders")
    stale = ResultKey(1_700_000_000_000 + _DAY_MILLIS, {"tag": "daily"})
    append_metrics(compute_metrics(orders, [Size()]), path, stale)
    for day in (0, 1, 2):
        _append_day(spark, sf_dir, path, day)
    compact_history(spark, path)
    for day in (3, 4):
        _append_day(spark, sf_dir, path, day)
    compact_history(spark, path)
    for day in (5, 6):
        _append_day(spark, sf_dir, path, day)
    history = read_history(spark, path, tags={"tag": "daily"}, first_day="2023-11-15")
    return rounded(success_metrics(history, ["tag"]), "value", digits=4)


@registered(
    """SELECT run, status, name, value FROM (VALUES
        ('first', 'Error', 'Size', (SELECT CAST(count(*) AS DOUBLE) FROM customer)),
        ('again', 'Success', 'Size', (SELECT CAST(count(*) AS DOUBLE) FROM orders)),
        ('stored', 'Success', 'Size', (SELECT CAST(count(*) AS DOUBLE) FROM orders))
    ) AS t(run, status, name, value)"""
)
def run_verification_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored verifications under one key, and what the history gives for it afterwards."""
    path, key = fresh_path(spark, "verifications"), ResultKey(1_700_000_000_000, {"tag": "nightly"})
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    least = orders.count()
    check = [Check("Error", "order rows").has_size(f"value >= {least}")]
    named = {"first": customer, "again": orders}
    runs = {name: run_verification(source, check, path, key) for name, source in named.items()}
    day = "2023-11-14"
    stored = read_history(spark, path, tags=key.tags, first_day=day, last_day=day)
    values = [run.metrics.select(F.lit(name).alias("run"), "name", "value") for name, run in runs.items()]
    values.append(stored.select(F.lit("again").alias("run"), "name", "value").withColumn("stored", F.lit(True)))
    statuses = [run.status().select(F.lit(name).alias("run"), "status") for name, run in runs.items()]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), values)
    judged = rows.join(reduce(DataFrame.unionByName, statuses), "run")
    run = F.when(F.col("stored"), "stored").otherwise(F.col("run"))
    return judged.select(run.alias("run"), "status", "name", "value")


# --- profiles ---------------------------------------------------------------------

# The declared profile types of the customer columns.
_CUSTOMER_TYPES = {
    "c_custkey": "Integral",
    "c_name": "String",
    "c_nationkey": "Integral",
    "c_acctbal": "Fractional",
    "c_mktsegment": "String",
}

_CLASS_SQL = r"""CASE WHEN v IS NULL THEN NULL
    WHEN regexp_full_match(v, '[+-]?\d+') THEN 'I'
    WHEN regexp_full_match(v, '[+-]?((\d+\.\d*|\.\d+)([eE][+-]?\d+)?|\d+[eE][+-]?\d+)') THEN 'F'
    WHEN v IN ('true', 'false') THEN 'B' ELSE 'S' END"""

_TYPE_SQL = """CASE WHEN count(class) = 0 THEN 'Unknown'
    WHEN bool_or(class = 'S') OR (bool_or(class = 'B') AND bool_or(class IN ('I', 'F'))) THEN 'String'
    WHEN bool_or(class = 'B') THEN 'Boolean'
    WHEN bool_or(class = 'F') THEN 'Fractional' ELSE 'Integral' END"""


def text_types_sql(source: str, names: list[str]) -> str:
    """Completeness and inferred type of string columns."""
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", count(v) / count(*) AS completeness,
            {_TYPE_SQL} AS inferred_datatype
        FROM (SELECT v, {_CLASS_SQL} AS class FROM (SELECT {name} AS v FROM {source}))"""
        for name in names
    )


@registered(
    f"""SELECT "column", round(completeness, 6) AS completeness, inferred_datatype,
        CAST(1700000000 AS BIGINT) AS timestamp
    FROM ({" UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", count({name}) / count(*) AS completeness,"
        f" '{kind}' AS inferred_datatype FROM customer"
        for name, kind in _CUSTOMER_TYPES.items())}
    UNION ALL {text_types_sql(_RAW, ["order_id", "cust_id", "status", "priority_code", "order_date"])})""",
    name="profile_table",
)
def profile_table_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The short profile of two tables; its distinct counts are in ``profile_distinct``."""
    profiles = [
        profile_table(profile_columns(df, statistics=False), 1_700_000_000)
        for df in (table(spark, sf_dir, "customer"), orders_raw(spark, sf_dir))
    ]
    both = reduce(DataFrame.unionAll, profiles).drop("approx_distinct_values")
    return rounded(both, "completeness")


_DISTINCT_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS "column", count(DISTINCT {name}) AS num_distinct FROM {source}"""
    for source, names in (("customer", _CUSTOMER_TYPES), (_RAW, COLUMNS))
    for name in names
)


@registered(
    f"""SELECT "column", round(completeness, 6) AS completeness, inferred_datatype, num_distinct,
        TRUE AS approx_is_close, CAST(1700000000 AS BIGINT) AS timestamp
    FROM ({" UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", count({name}) / count(*) AS completeness,"
        f" '{kind}' AS inferred_datatype FROM customer"
        for name, kind in _CUSTOMER_TYPES.items())}
    UNION ALL {text_types_sql(_RAW, list(COLUMNS))})
    JOIN ({_DISTINCT_SQL}) USING ("column")"""
)
def profile_table_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the short profile; its distinct counts are held against exact ones, within a fifth."""
    parts = []
    for df in (table(spark, sf_dir, "customer"), orders_raw(spark, sf_dir)):
        names = df.columns
        profile = profile_table(profile_columns(df, statistics=False), 1_700_000_000)
        groups = frequencies(df, [[column(name)] for name in names])
        exact = groups.groupBy("key_no").agg(F.count(F.lit(1)).alias("num_distinct"))
        label = F.element_at(F.array(*map(F.lit, names)), F.col("key_no") + 1).alias("column")
        parts.append(profile.join(exact.select(label, "num_distinct"), "column"))
    apart = F.abs(F.col("approx_distinct_values") - F.col("num_distinct"))
    close = (apart <= 0.2 * F.col("num_distinct")).alias("approx_is_close")
    return rounded(reduce(DataFrame.unionAll, parts), "completeness").select(
        "column", "completeness", "inferred_datatype", "num_distinct", close, "timestamp"
    )


# The raw orders 30 times side by side, each time with other rows blanked: 150 columns of text.
_WIDE = [
    f"CASE WHEN o_orderkey % {k + 2} = 0 THEN NULL ELSE {text} END AS {name}_{k}"
    for k in range(30)
    for name, text in COLUMNS.items()
]


@registered(
    f"""WITH wide AS (SELECT {", ".join(_WIDE)} FROM orders),
        long AS (SELECT "column", v, {_CLASS_SQL} AS class
            FROM wide UNPIVOT INCLUDE NULLS (v FOR "column" IN (COLUMNS(*)))),
        facts AS (SELECT "column", count(v) / count(*) AS completeness, {_TYPE_SQL} AS kind,
            min(x) AS low, max(x) AS high, avg(x) AS mean, stddev_pop(x) AS spread
            FROM (SELECT *, CASE WHEN class IN ('I', 'F') THEN TRY_CAST(v AS DOUBLE) END AS x FROM long)
            GROUP BY "column")
    SELECT "column", round(completeness, 6) AS completeness, kind AS inferred_datatype,
        {", ".join(f"CASE WHEN kind IN ('Integral', 'Fractional') THEN round({fact}, 6) END AS {name}"
                   for name, fact in (("minimum", "low"), ("maximum", "high"), ("mean", "mean"), ("std_dev", "spread")))}
    FROM facts""",
    name="profile_wide",
)
def profile_wide_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of 150 text columns, profiled by one aggregate over (column, value) entries."""
    wide = table(spark, sf_dir, "orders").selectExpr(*_WIDE)
    facts = profile_wide(wide, distinct=False)
    return rounded(facts, "completeness", "minimum", "maximum", "mean", "std_dev")


# Lineitem as text, one column per way a type can come out.
_LINEITEM_TEXTS = [
    "CAST(l_linenumber AS STRING) AS line",
    "CAST(l_quantity AS STRING) AS quantity",
    """CASE WHEN l_linenumber = 1 THEN CAST(l_linenumber AS STRING)
        ELSE CAST(l_discount AS STRING) END AS mixed_number""",
    """CASE WHEN l_discount > 0.05 THEN 'true' WHEN l_discount < 0.02 THEN NULL
        ELSE 'false' END AS flag""",
    """CASE WHEN l_linenumber = 2 THEN 'true'
        ELSE CAST(l_linenumber AS STRING) END AS flag_or_number""",
    "l_shipdate AS shipdate",
    "CAST(NULL AS STRING) AS nothing",
    "l_returnflag AS letter",
]
_LINEITEM_TEXT = f"(SELECT {', '.join(_LINEITEM_TEXTS)} FROM lineitem) texts"


@registered(
    f"""SELECT "column", round(completeness, 6) AS completeness, inferred_datatype,
        CAST(round(minimum, 6) AS DOUBLE) AS minimum, CAST(round(maximum, 6) AS DOUBLE) AS maximum
    FROM ({" UNION ALL ".join(
        f"SELECT *, (SELECT {low} FROM {_LINEITEM_TEXT}) AS minimum,"
        f" (SELECT {high} FROM {_LINEITEM_TEXT}) AS maximum"
        f" FROM ({text_types_sql(_LINEITEM_TEXT, [name])})"
        for name, low, high in [
            *[(n, f"min(TRY_CAST({n} AS DOUBLE))", f"max(TRY_CAST({n} AS DOUBLE))")
              for n in ("line", "quantity", "mixed_number")],
            *[(n, "max(CAST(NULL AS DOUBLE))", "max(CAST(NULL AS DOUBLE))")
              for n in ("flag", "flag_or_number", "nothing", "letter")],
        ])}
    UNION ALL SELECT 'shipdate', count(shipdate) / count(*), 'String', NULL, NULL
        FROM {_LINEITEM_TEXT})"""
)
def profile_inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "lineitem").selectExpr(*_LINEITEM_TEXTS)
    profile = profile_columns(texts, distinct=False).drop("mean", "std_dev")
    return rounded(profile, "completeness", "minimum", "maximum")


_TEXT_NUMBERS = ["line", "quantity", "mixed_number"]


@registered(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", round(avg(TRY_CAST({name} AS DOUBLE)), 6) AS mean,
            round(stddev_pop(TRY_CAST({name} AS DOUBLE)), 6) AS std_dev FROM {_LINEITEM_TEXT}"""
        for name in _TEXT_NUMBERS
    )
    + " UNION ALL "
    + " UNION ALL ".join(
        f"SELECT '{name}', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)"
        for name in ("flag", "flag_or_number", "shipdate", "nothing", "letter")
    )
)
def profile_text_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and standard deviation of text that is numeric throughout, null for other text."""
    texts = table(spark, sf_dir, "lineitem").selectExpr(*_LINEITEM_TEXTS)
    profile = profile_columns(texts, distinct=False).select("column", "mean", "std_dev")
    return rounded(profile, "mean", "std_dev")


@registered(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", count(DISTINCT {name}) AS num_distinct, TRUE AS approx_is_close
        FROM customer"""
        for name in _CUSTOMER_TYPES
    )
)
def profile_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate distinct counts held against exact ones, within a fifth."""
    customer = table(spark, sf_dir, "customer")
    names = customer.columns
    approx = compute_metrics(customer, [ApproxDistinct(name) for name in names])
    groups = frequencies(customer, [[column(name)] for name in names])
    exact = groups.groupBy("key_no").agg(F.count(F.lit(1)).alias("num_distinct"))
    label: Column = F.element_at(F.array(*map(F.lit, names)), F.col("key_no") + 1)
    return (
        exact.select(label.alias("column"), "num_distinct")
        .join(F.broadcast(approx), F.col("column") == F.col("instance"))
        .select(
            "column",
            "num_distinct",
            (F.abs(F.col("value") - F.col("num_distinct")) <= 0.2 * F.col("num_distinct")).alias(
                "approx_is_close"
            ),
        )
    )


_LINEITEM_NUMBERS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    "l_quantity", "l_extendedprice", "l_discount", "l_tax",
]


@registered(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", round(CAST(min({name}) AS DOUBLE), 6) AS minimum,
            round(CAST(max({name}) AS DOUBLE), 6) AS maximum, round(avg({name}), 6) AS mean,
            round(stddev_pop({name}), 6) AS std_dev FROM lineitem"""
        for name in _LINEITEM_NUMBERS
    )
)
def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = table(spark, sf_dir, "lineitem").select(*_LINEITEM_NUMBERS)
    facts = profile_columns(numbers, distinct=False).drop("completeness", "inferred_datatype")
    return rounded(facts, "minimum", "maximum", "mean", "std_dev")


def histogram_sql(source: str, names: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", coalesce(CAST({name} AS VARCHAR), 'NullValue') AS value,
            count(*) AS absolute,
            round(count(*) / (SELECT count(*) FROM {source}), 6) AS ratio
        FROM {source} GROUP BY {name}"""
        for name in names
    )


@registered(
    histogram_sql(_RAW, ["status", "priority_code"])
    + " UNION ALL "
    + histogram_sql("events", ["event_type"])
    + " UNION ALL "
    + histogram_sql("lineitem", ["l_returnflag", "l_linestatus", "l_linenumber"])
)
def profile_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        histograms(orders_raw(spark, sf_dir), ["status", "priority_code"]),
        histograms(table(spark, sf_dir, "events"), ["event_type"]),
        histograms(
            table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"]
        ),
    ]
    return rounded(reduce(DataFrame.unionAll, parts), "ratio")


@registered(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "column" FROM lineitem HAVING count(DISTINCT {name}) < 30"""
        for name in [*_LINEITEM_NUMBERS, "l_returnflag", "l_linestatus", "l_shipdate"]
    ),
    name="low_cardinality_columns",
)
def low_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = profile_columns(table(spark, sf_dir, "lineitem"), statistics=False)
    profile = profile_table(facts, 1_700_000_000)
    return low_cardinality_columns(profile, below=30)


@registered(
    f"""SELECT "column", round(completeness, 6) AS completeness, inferred_datatype,
        CAST(round(minimum, 6) AS DOUBLE) AS minimum, CAST(round(maximum, 6) AS DOUBLE) AS maximum
    FROM ({" UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", count({name}) / count(*) AS completeness,"
        f" '{kind}' AS inferred_datatype,"
        + (f" CAST(min({name}) AS DOUBLE) AS minimum, CAST(max({name}) AS DOUBLE) AS maximum"
           if kind != "String" else " NULL AS minimum, NULL AS maximum")
        + " FROM customer"
        for name, kind in _CUSTOMER_TYPES.items())})"""
)
def profile_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = run_profile(
        table(spark, sf_dir, "customer"),
        fresh_path(spark, "profile"),
        "customer",
        "2023-11-14T22:13:20.000Z",
    )
    facts = done.profile.select(
        "column", "completeness", "inferred_datatype", "minimum", "maximum"
    )
    return rounded(facts, "completeness", "minimum", "maximum")


@registered(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", round(avg({name}), 4) AS mean, round(stddev_pop({name}), 4) AS std_dev,
            (SELECT count(DISTINCT {name}) FROM customer) AS num_distinct, TRUE AS approx_is_close FROM customer"""
        if kind != "String"
        else f"""SELECT '{name}', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
            (SELECT count(DISTINCT {name}) FROM customer), TRUE"""
        for name, kind in _CUSTOMER_TYPES.items()
    )
)
def profile_json_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other facts of a stored profile: spread, and distinct counts against exact ones."""
    customer = table(spark, sf_dir, "customer")
    done = run_profile(customer, fresh_path(spark, "profile"), "customer", "2023-11-14T22:13:20.000Z")
    groups = frequencies(customer, [[column(name)] for name in customer.columns])
    exact = groups.groupBy("key_no").agg(F.count(F.lit(1)).alias("num_distinct"))
    label = F.element_at(F.array(*map(F.lit, customer.columns)), F.col("key_no") + 1).alias("column")
    facts = done.profile.join(exact.select(label, "num_distinct"), "column")
    close = F.abs(F.col("approx_distinct_values") - F.col("num_distinct")) <= 0.2 * F.col("num_distinct")
    kept = facts.select("column", "mean", "std_dev", "num_distinct", close.alias("approx_is_close"))
    return rounded(kept, "mean", "std_dev", digits=4)


@registered(histogram_sql("customer", ["c_nationkey", "c_mktsegment"]))
def profile_run_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histograms that a profile run chooses by itself."""
    done = run_profile(
        table(spark, sf_dir, "customer"),
        fresh_path(spark, "profile"),
        "customer",
        "2023-11-14T22:13:20.000Z",
    )
    return rounded(done.histograms, "ratio")


# --- indicator aggregation and preview --------------------------------------------


@registered(
    """SELECT count(*) AS num_rows,
        round(count(*) FILTER (WHERE l_discount >= 0.05) / count(*), 6) AS share_discounted,
        round(4.0 * (count(*) FILTER (WHERE x * x + y * y <= 1) / count(*)), 6) AS four_shares_in_disc
    FROM (SELECT l_discount, (l_quantity - 25) / 25 AS x, l_tax / 0.08 * 2 - 1 AS y FROM lineitem)"""
)
def indicator_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    x = (F.col("l_quantity") - 25) / 25
    y = F.col("l_tax") / 0.08 * 2 - 1
    return lineitem.agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.round(share_of(F.col("l_discount") >= 0.05), 6).alias("share_discounted"),
        F.round(F.lit(4.0) * share_of(x * x + y * y <= 1), 6).alias("four_shares_in_disc"),
    )


@registered("SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def preview_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "orders"), 10, ["o_orderkey"])
