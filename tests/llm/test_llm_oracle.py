"""Registered corpus queries against their SQL on an independent engine, over whole tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from rowsieve.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    theirs = con.execute(ORACLES[name])
    columns = [d[0] for d in theirs.description]
    ours = QUERIES[name](spark, SF_DIR)
    assert sorted(ours.columns) == sorted(columns)
    got = sorted(tuple(map(repr, row)) for row in ours.select(*columns).collect())
    assert got == sorted(tuple(map(repr, row)) for row in theirs.fetchall())
    assert got
