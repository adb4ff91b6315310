"""What the plan of every registered query must not hold, whatever its tables' size."""

from __future__ import annotations

import re

import pytest

from rowsieve.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

FORBIDDEN = [
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "ArrowEvalPython",
    "BatchEvalPython",
    "MapInPandas",
    "FlatMapGroupsInPandas",
    "InMemoryRelation",
    "Scan ExistingRDD",
]

# Scans of each table file that a query may plan; all others scan a table once.
SCANS = {
    # orders as they are and as raw text
    "check_unique": 2,
    # once for the scan metrics, once for the uniqueness keys
    "verification_report": 2,
    "verification_failures": 2,
    "verification_status": 2,
    "metrics_long": 2,
    # approximate and exact counts side by side
    "profile_distinct": 2,
    "profile_table_whole": 2,
}


def final_plan(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("Initial Plan")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, name):
    plan = final_plan(QUERIES[name](spark, SF_DIR))
    assert not [node for node in FORBIDDEN if node in plan]
    scans: dict[str, int] = {}
    for path in re.findall(r"FileScan parquet.*?Location: InMemoryFileIndex\(1 paths\)\[(.*?)\]", plan):
        if path.startswith("file:/root/testdata"):
            scans[path] = scans.get(path, 0) + 1
    assert all(count <= SCANS.get(name, 1) for count in scans.values()), scans


def test_a_projection_reads_only_its_columns(spark):
    plan = final_plan(QUERIES["indicator_ratio"](spark, SF_DIR))
    (schema,) = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    assert schema == "l_quantity:double,l_discount:double,l_tax:double"


def test_preview_takes_the_first_rows_without_a_full_sort(spark):
    plan = final_plan(QUERIES["preview_top_n"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan and "Sort " not in plan.replace("TakeOrdered", "")
