from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from rowsieve import histograms, low_cardinality_columns, profile_columns, profile_table
from rowsieve.operators import profile_wide


def by_column(df):
    return {row["column"]: row.asDict() for row in df.collect()}


@pytest.mark.parametrize(
    ("texts", "kind"),
    [
        (["1", "-2", "+3", None], "Integral"),
        (["1", "2.5"], "Fractional"),
        ([".5", "3.", "1e5", "-2.5E-3"], "Fractional"),
        (["true", "false"], "Boolean"),
        (["true", "1"], "String"),
        (["true", "x"], "String"),
        (["1", ""], "String"),
        (["1", "-"], "String"),
        (["1", "2015-08-31"], "String"),
        (["1e", "2"], "String"),
        (["+", "/"], "String"),
        ([None, None], "Unknown"),
    ],
)
def test_inferred_type_of_text(spark, texts, kind):
    df = spark.createDataFrame([(text,) for text in texts], "v string")
    row = profile_columns(df).first()
    assert row["inferred_datatype"] == kind
    if kind in ("Integral", "Fractional"):
        numbers = [float(text) for text in texts if text is not None]
        assert (row["minimum"], row["maximum"]) == (min(numbers), max(numbers))
        assert row["mean"] == pytest.approx(statistics.mean(numbers))
        assert row["std_dev"] == pytest.approx(statistics.pstdev(numbers))
    else:
        assert row["minimum"] is row["mean"] is row["std_dev"] is None


def test_declared_types(spark):
    df = spark.sql(
        "SELECT 1 AS i, 2L AS l, CAST(1 AS TINYINT) AS t, 1.5D AS d, 1.5BD AS m, true AS b,"
        " DATE'2020-01-01' AS day, TIMESTAMP'2020-01-01' AS ts, 'x' AS s, array(1) AS a"
    )
    kinds = {name: row["inferred_datatype"] for name, row in by_column(profile_columns(df)).items()}
    assert kinds == {
        "i": "Integral", "l": "Integral", "t": "Integral", "d": "Fractional", "m": "Fractional",
        "b": "Boolean", "day": "String", "ts": "String", "s": "String", "a": "Unknown",
    }


def test_map_columns_have_no_distinct_count(spark):
    row = profile_columns(spark.sql("SELECT map('a', 1) AS m")).first()
    assert (row["inferred_datatype"], row["approx_distinct_values"]) == ("Unknown", None)


def test_votes(spark):
    votes = [0] * 14 + [1] * 8 + [3, 4]
    df = spark.createDataFrame([(v,) for v in votes], "votes int")
    row = profile_columns(df).first()
    assert (row["minimum"], row["maximum"], row["mean"]) == (0.0, 4.0, 0.625)
    assert row["std_dev"] == pytest.approx(0.992157, abs=1e-6)
    assert row["approx_distinct_values"] == 4 and row["completeness"] == 1.0


def test_empty_table(spark):
    row = profile_columns(spark.createDataFrame([], "s string")).first()
    assert row["completeness"] is None and row["inferred_datatype"] == "Unknown"
    assert row["approx_distinct_values"] == 0 and row["minimum"] is None
    assert histograms(spark.createDataFrame([], "s string"), ["s"]).count() == 0


def test_profile_is_one_scan_and_can_leave_facts_out(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    full = profile_columns(df)
    assert full._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    short = profile_columns(df, distinct=False, statistics=False)
    assert short.columns == ["column", "completeness", "inferred_datatype"]
    assert [row["column"] for row in short.collect()] == df.columns
    assert full.columns == [
        "column", "completeness", "inferred_datatype", "approx_distinct_values",
        "minimum", "maximum", "mean", "std_dev",
    ]


def test_profile_table_and_low_cardinality(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("few"), F.lit("x").alias("one"))
    table = profile_table(profile_columns(df), 1_700_000_000)
    assert table.columns == [
        "column", "completeness", "inferred_datatype", "approx_distinct_values", "timestamp",
    ]
    assert {row["timestamp"] for row in table.collect()} == {1_700_000_000}
    assert [row["column"] for row in low_cardinality_columns(table).collect()] == ["few", "one"]
    assert [row["column"] for row in low_cardinality_columns(table, below=2).collect()] == ["one"]


def test_histograms(spark):
    df = spark.createDataFrame([("a", 5), ("a", 4), (None, 5), ("b", 5)], "s string, `n.x` int")
    got = {(r["column"], r["value"]): (r["absolute"], r["ratio"]) for r in histograms(df, df.columns).collect()}
    assert got == {
        ("s", "a"): (2, 0.5),
        ("s", "b"): (1, 0.25),
        ("s", "NullValue"): (1, 0.25),
        ("n.x", "5"): (3, 0.75),
        ("n.x", "4"): (1, 0.25),
    }


def test_histogram_counts_add_up_and_ignore_partitioning(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    names = ["l_returnflag", "l_linenumber"]
    hist = histograms(df, names)
    rows = sorted(tuple(row) for row in hist.collect())
    for name in names:
        assert sum(row[2] for row in rows if row[0] == name) == df.count()
        assert sum(row[3] for row in rows if row[0] == name) == pytest.approx(1)
    assert rows == sorted(tuple(row) for row in histograms(df.repartition(11), names).collect())


def test_histograms_scan_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    hist = histograms(df, ["l_returnflag", "l_linestatus"])
    hist.collect()
    plan = hist._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_wide_table(spark):
    df = spark.range(50).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(150)])
    rows = by_column(profile_columns(df))
    assert len(rows) == 150 and rows["c149"]["minimum"] == 149.0


def test_wide_profile_equals_the_narrow_one(spark):
    """Types of every kind, nulls, faulty numbers, an empty table, odd names."""
    df = spark.sql(
        """SELECT CAST(id AS INT) AS i, CAST(id % 5 AS DOUBLE) AS `a.b`, CAST(id AS STRING) AS num,
            CASE WHEN id % 3 = 0 THEN NULL ELSE CAST(id / 4 AS STRING) END AS frac,
            CASE WHEN id = 7 THEN 'x' ELSE CAST(id AS STRING) END AS mixed,
            CAST(id % 2 = 0 AS STRING) AS flag, id % 2 = 0 AS truth, CAST(NULL AS STRING) AS nothing,
            DATE'2020-01-01' AS day, array(id) AS list, map('k', id) AS pairs, CAST(id AS DECIMAL(10, 2)) AS money
        FROM range(40)"""
    )
    for rows in (df, df.where("i < 0")):
        narrow, wide = by_column(profile_columns(rows)), by_column(profile_wide(rows))
        assert narrow.keys() == wide.keys()
        for name, facts in narrow.items():
            close = wide[name].pop("approx_distinct_values"), facts.pop("approx_distinct_values")
            assert close[0] == close[1] or abs(close[0] - close[1]) <= 4
            assert wide[name] == pytest.approx(facts), name
    assert profile_wide(df, distinct=False, statistics=False).columns == ["column", "completeness", "inferred_datatype"]


def test_wide_profile_stays_narrow_in_its_plan(spark):
    df = spark.range(50).select(*[(F.col("id") + i).cast("string").alias(f"c{i}") for i in range(150)])
    wide = profile_wide(df)
    assert by_column(wide)["c149"]["minimum"] == 149.0
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("approx_count_distinct") == 1
