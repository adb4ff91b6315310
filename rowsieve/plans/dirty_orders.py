"""``orders_raw``: the orders table as raw text with faults placed by key.

The test tables are typed and clean, so the row rules need a table that is neither.
Every order is in it; what is wrong with a row depends on its key alone, which lets
an independent SQL engine build the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowsieve.operators import RowSchema

COLUMNS = {
    "order_id": """CASE WHEN o_orderkey % 97 = 0 THEN 'x' || CAST(o_orderkey AS STRING)
        WHEN o_orderkey % 89 = 0 THEN '99999999999'
        ELSE CAST(o_orderkey AS STRING) END""",
    "cust_id": "CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END",
    "status": """CASE WHEN o_orderkey % 53 = 0 THEN 'Z'
        WHEN o_orderkey % 59 = 0 THEN NULL
        WHEN o_orderkey % 101 = 0 THEN 'XOX'
        ELSE o_orderstatus END""",
    "priority_code": """CASE WHEN o_orderkey % 71 = 0 THEN lower(o_orderpriority)
        ELSE o_orderpriority END""",
    "order_date": """CASE WHEN o_orderkey % 61 = 0 THEN '2015-13-31'
        WHEN o_orderkey % 67 = 0 THEN '2015-02-31'
        ELSE substr(CAST(o_orderdate AS STRING), 1, 10) END""",
}


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.selectExpr(*[f"{text} AS {name}" for name, text in COLUMNS.items()])


def order_rules(*, full_match: bool = False) -> RowSchema:
    return (
        RowSchema()
        .int_column("order_id", is_nullable=False)
        .int_column("cust_id", is_nullable=False)
        .string_column("status", is_nullable=False, matches="O|F|P", full_match=full_match)
        .string_column("priority_code", is_nullable=False, matches="^[0-9]-[A-Z ]+$")
        .timestamp_column("order_date", mask="yyyy-MM-dd", is_nullable=False)
    )


RAW_SQL = "SELECT " + ", ".join(f"{text} AS {name}" for name, text in COLUMNS.items()) + " FROM orders"

_INT = r"""({0} IS NULL OR (regexp_full_match(trim({0}), '[+-]?\d+')
    AND TRY_CAST(trim({0}) AS INTEGER) IS NOT NULL))"""

TESTS_SQL = {
    "order_id:not_null": "(order_id IS NOT NULL)",
    "order_id:int": _INT.format("order_id"),
    "cust_id:not_null": "(cust_id IS NOT NULL)",
    "cust_id:int": _INT.format("cust_id"),
    "status:not_null": "(status IS NOT NULL)",
    "status:matches": "(status IS NULL OR regexp_matches(status, 'O|F|P'))",
    "priority_code:not_null": "(priority_code IS NOT NULL)",
    "priority_code:matches": "(priority_code IS NULL"
    " OR regexp_matches(priority_code, '^[0-9]-[A-Z ]+$'))",
    "order_date:not_null": "(order_date IS NOT NULL)",
    "order_date:timestamp": r"(order_date IS NULL OR (regexp_full_match(order_date,"
    r" '\d{4}-\d{2}-\d{2}') AND try_strptime(order_date, '%Y-%m-%d') IS NOT NULL))",
}


def flag_name(key: str) -> str:
    return key.replace(":", "_")


def flagged_sql(*, full_match: bool = False, source: str = RAW_SQL) -> str:
    """SQL of the flagged table: raw columns, a boolean per test, ``is_valid``."""
    tests = dict(TESTS_SQL)
    if full_match:
        tests["status:matches"] = "(status IS NULL OR regexp_full_match(status, 'O|F|P'))"
    flags = ", ".join(f"{test} AS {flag_name(key)}" for key, test in tests.items())
    return f"SELECT *, {flags}, {' AND '.join(tests.values())} AS is_valid FROM ({source}) raw"


TYPED_SQL = """CAST(trim(order_id) AS INTEGER) AS order_id, CAST(trim(cust_id) AS INTEGER) AS cust_id,
    status, priority_code, strptime(order_date, '%Y-%m-%d') AS order_date"""
