from __future__ import annotations

import pytest

from rowsieve import Check, Size, compute_metrics, verify
from rowsieve.operators.checks import evaluate

ROWS = [("r1", 1, "N", 0), ("r2", 2, "N", 4), ("r2", None, "Y", -1), ("r3", 4, None, None)]


@pytest.fixture(scope="module")
def reviews(spark):
    return spark.createDataFrame(ROWS, "id string, cust int, vine string, votes int")


def integrity(level="Error"):
    return (
        Check(level, "rows of the table")
        .has_size("value = 5")
        .is_complete("id")
        .is_unique("id")
        .is_complete("cust")
        .is_contained_in("vine", ["Y", "N"])
        .is_non_negative("votes")
    )


def distribution(limit=10):
    return Check("Warning", "spread of the table").has_approx_quantile(
        "votes", 0.5, lambda v: v <= limit
    )


def statuses(run):
    return {row["constraint"]: row["status"] for row in run.results.collect()}


def test_report(reviews):
    run = verify(reviews, [integrity(), distribution()])
    assert statuses(run) == {
        "Size": "Failure",
        "Completeness(id)": "Success",
        "Uniqueness(id)": "Failure",
        "Completeness(cust)": "Failure",
        "Compliance(vine contained in Y,N)": "Success",
        "Compliance(votes is non-negative)": "Failure",
        "ApproxQuantile-0.5(votes)": "Success",
    }
    failures = {row["constraint"]: row["message"] for row in run.failures().collect()}
    assert failures == {
        "Size": "value 4.000000 does not meet: value = 5",
        "Uniqueness(id)": "value 0.500000 does not meet: value = 1",
        "Completeness(cust)": "value 0.750000 does not meet: value = 1",
        "Compliance(votes is non-negative)": "value 0.750000 does not meet: value = 1",
    }
    assert run.metrics.count() == 7


@pytest.mark.parametrize(
    ("checks", "by_check", "overall"),
    [
        ([integrity(), distribution()], {"Error", "Success"}, "Error"),
        ([integrity("Warning"), distribution()], {"Warning", "Success"}, "Warning"),
        ([integrity("Warning"), distribution(-5)], {"Warning"}, "Warning"),
        ([integrity(), distribution(-5)], {"Error", "Warning"}, "Error"),
        ([distribution()], {"Success"}, "Success"),
    ],
)
def test_status_roll_up(reviews, checks, by_check, overall):
    run = verify(reviews, checks)
    assert {row["status"] for row in run.check_status().collect()} == by_check
    assert run.status().first()["status"] == overall


def test_an_empty_table_fails_with_a_message(spark):
    run = verify(
        spark.createDataFrame([], "id string, cust int, vine string, votes int"),
        [integrity(), distribution()],
    )
    failed = {row["constraint"]: row["message"] for row in run.failures().collect()}
    assert failed["Size"] == "value 0.000000 does not meet: value = 5"
    assert failed["Uniqueness(id)"] == "Uniqueness(id) has no value: no rows"
    assert len(failed) == 7


def test_a_metric_that_is_missing_fails_its_constraint(reviews):
    check = Check("Error", "c").has_size("value > 0").is_complete("id")
    results = evaluate(compute_metrics(reviews, [Size()]), [check])
    got = {row["constraint"]: row["status"] for row in results.collect()}
    assert got == {"Size": "Success", "Completeness(id)": "Failure"}


def test_one_metric_may_serve_several_constraints(reviews):
    check = Check("Warning", "c").has_size("value > 0").has_size("value > 100")
    run = verify(reviews, [check, Check("Error", "d").has_size(lambda n: n == 4)])
    assert sorted(row["status"] for row in run.results.collect()) == ["Failure", "Success", "Success"]
    assert run.metrics.count() == 1
    texts = {row["message"] for row in run.failures().collect()}
    assert texts == {"value 4.000000 does not meet: value > 100"}


def test_functions_are_shown_as_conditions(reviews):
    check = (
        Check("Error", "c")
        .has_size(lambda n: n == 5)
        .constrain(Size(), lambda n: n >= 10)
        .constrain(Size(), lambda n: (n > 8) & (n < 9))
    )
    texts = [row["message"].split(": ")[1] for row in verify(reviews, [check]).failures().collect()]
    assert texts[:2] == ["value = 5", "value >= 10"]
    assert "value" in texts[2]


def test_a_null_verdict_is_a_failure(reviews):
    run = verify(reviews, [Check("Error", "c").has_size("value > CAST(NULL AS INT)")])
    assert statuses(run) == {"Size": "Failure"}


def test_many_constraints(spark):
    check = Check("Error", "many")
    for i in range(150):
        check = check.satisfies(f"id <> {i}", f"not {i}", "value >= 0.5")
    run = verify(spark.range(200), [check])
    assert {row["status"] for row in run.results.collect()} == {"Success"}
    assert run.results.count() == 150


def test_mistakes_are_refused(reviews):
    with pytest.raises(ValueError, match="level"):
        Check("Fatal", "x")
    with pytest.raises(ValueError):
        verify(reviews, [Check("Error", "nothing")])


def test_verification_scans_once_for_scan_metrics(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    check = Check("Error", "c").has_size("value > 0").is_complete("o_custkey").is_non_negative(
        "o_totalprice"
    )
    plan = verify(df, [check]).results._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan
    with_key = verify(df, [check.is_unique("o_orderkey").is_unique("o_custkey")])
    plan = with_key.results._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "CartesianProduct" not in plan and "Python" not in plan
