"""Every registered query against its SQL on an independent engine, over whole tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from rowsieve.plans.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

FAMILY = {
    "tinyint": "int",
    "smallint": "int",
    "integer": "int",
    "int": "int",
    "bigint": "bigint",
    "varchar": "string",
    "string": "string",
    "double": "double",
    "boolean": "boolean",
    "timestamp": "timestamp",
    "timestamp_ntz": "timestamp",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def canonical(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLES.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = duck.execute(ORACLES[name])
    columns = {d[0]: FAMILY[str(d[1]).lower()] for d in theirs.description}
    assert {f.name: FAMILY[f.dataType.simpleString()] for f in ours.schema} == columns
    expected = rows_of(list(columns), theirs.fetchall())
    got = rows_of(ours.columns, [tuple(row) for row in ours.collect()])
    assert len(got) == len(expected)
    assert got == expected
    assert got


def test_entry(spark):
    row = entry_points.entry(spark).first()
    assert row["num_valid_rows"] + row["num_invalid_rows"] == 1500
