"""Checks: assertions on metrics, at error or warning level, evaluated in the plan.

``verify`` collects the metrics that all checks need, computes them together and
lays the constraints over the metric rows. Nothing is fetched to decide a status:
results, failures, roll-up and metric table are all DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsieve.functions import cases, column_label, literal_rows
from rowsieve.operators.metrics import (
    ApproxQuantile,
    Completeness,
    Compliance,
    Containment,
    NonNegative,
    Size,
    Uniqueness,
    compute_metrics,
    identity,
)

ERROR, WARNING, SUCCESS, FAILURE = "Error", "Warning", "Success", "Failure"

# SQL text over ``value``, or a function from the value column to a condition.
Assertion = str | Callable[[Column], Column]

IS_ONE = "value = 1"


@dataclass(frozen=True)
class Constraint:
    metric: object
    assertion: Assertion

    @property
    def label(self) -> str:
        if self.metric.entity == "Dataset":
            return self.metric.name
        return f"{self.metric.name}({self.metric.instance})"

    def condition(self) -> Column:
        if callable(self.assertion):
            return self.assertion(F.col("value"))
        return F.expr(self.assertion)

    @property
    def assertion_text(self) -> str:
        if callable(self.assertion):
            return column_label(self.condition())
        return self.assertion


@dataclass(frozen=True)
class Check:
    """Named constraints that share a level; a failed one gives the check its level."""

    level: str
    description: str
    constraints: tuple[Constraint, ...] = ()

    def __post_init__(self) -> None:
        if self.level not in (ERROR, WARNING):
            raise ValueError(f"level must be {ERROR!r} or {WARNING!r}, not {self.level!r}")

    def constrain(self, metric: object, assertion: Assertion) -> Check:
        return replace(self, constraints=(*self.constraints, Constraint(metric, assertion)))

    def has_size(self, assertion: Assertion) -> Check:
        return self.constrain(Size(), assertion)

    def is_complete(self, column: str) -> Check:
        return self.constrain(Completeness(column), IS_ONE)

    def is_unique(self, *columns: str, digest: bool = False) -> Check:
        return self.constrain(Uniqueness(columns, digest), IS_ONE)

    def is_contained_in(
        self, column: str, values: Sequence, assertion: Assertion = IS_ONE
    ) -> Check:
        return self.constrain(Containment(column, tuple(values)), assertion)

    def is_non_negative(self, column: str, assertion: Assertion = IS_ONE) -> Check:
        return self.constrain(NonNegative(column), assertion)

    def has_approx_quantile(
        self, column: str, quantile: float, assertion: Assertion, *, accuracy: int = 1000
    ) -> Check:
        return self.constrain(ApproxQuantile(column, quantile, accuracy), assertion)

    def satisfies(self, predicate: str, label: str, assertion: Assertion = IS_ONE) -> Check:
        return self.constrain(Compliance(label, predicate), assertion)


_CONSTRAINT_TYPES = {
    "no": "int",
    "check": "string",
    "level": "string",
    "constraint": "string",
    "assertion": "string",
    "entity": "string",
    "instance": "string",
    "metric": "string",
}


def required_metrics(checks: Iterable[Check]) -> list:
    return [constraint.metric for check in checks for constraint in check.constraints]


def evaluate(metrics: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Lay constraints over metric rows: one result row per constraint.

    The metric rows are as many as the checks name, so they are broadcast.
    """
    listed = [(check, constraint) for check in checks for constraint in check.constraints]
    if not listed:
        raise ValueError("no constraints to evaluate")
    rows = [
        (no, c.description, c.level, k.label, k.assertion_text, *identity(k.metric))
        for no, (c, k) in enumerate(listed)
    ]
    constraints = literal_rows(metrics.sparkSession, rows, _CONSTRAINT_TYPES)
    known = metrics.select("entity", "instance", F.col("name").alias("metric"), "value")
    laid = constraints.join(F.broadcast(known), ["entity", "instance", "metric"], "left")

    met = cases((F.col("no") == no, k.condition()) for no, (_, k) in enumerate(listed))
    passed = F.coalesce(met, F.lit(False))
    message = (
        F.when(passed, F.lit(""))
        .when(
            F.col("value").isNull(),
            F.format_string("%s has no value: no rows", F.col("constraint")),
        )
        .otherwise(
            F.format_string("value %.6f does not meet: %s", F.col("value"), F.col("assertion"))
        )
    )
    return laid.select(
        "check",
        "level",
        "constraint",
        "metric",
        "instance",
        "value",
        F.when(passed, F.lit(SUCCESS)).otherwise(F.lit(FAILURE)).alias("status"),
        message.alias("message"),
    )


def failed_constraints(results: DataFrame) -> DataFrame:
    """The constraints that did not hold, with why."""
    failed = results.where(F.col("status") != SUCCESS)
    return failed.select("check", "level", "constraint", "message")


def _worst(level_of_failures: Column) -> Column:
    rank = F.max(level_of_failures)
    return F.when(rank == 2, ERROR).when(rank == 1, WARNING).otherwise(SUCCESS)


def _rank() -> Column:
    failed = F.col("status") != SUCCESS
    return (
        F.when(failed & (F.col("level") == ERROR), 2)
        .when(failed & (F.col("level") == WARNING), 1)
        .otherwise(0)
    )


def check_status(results: DataFrame) -> DataFrame:
    """One row per check: its level if any of its constraints failed, else Success."""
    return results.groupBy("check", "level").agg(_worst(_rank()).alias("status"))


def overall_status(results: DataFrame) -> DataFrame:
    """One row: the worst status of the run."""
    return results.agg(_worst(_rank()).alias("status"))


@dataclass(frozen=True)
class Verification:
    """Metric rows and constraint results of a run."""

    metrics: DataFrame
    results: DataFrame

    def failures(self) -> DataFrame:
        return failed_constraints(self.results)

    def check_status(self) -> DataFrame:
        return check_status(self.results)

    def status(self) -> DataFrame:
        return overall_status(self.results)


def verify(df: DataFrame, checks: Sequence[Check]) -> Verification:
    """Plan the metrics of all checks in one scan (two with uniqueness) and judge them.

    The plan runs again for every result read from it; ``run_verification`` stores
    the metrics first and judges the stored rows.
    """
    metrics = compute_metrics(df, required_metrics(checks))
    return Verification(metrics, evaluate(metrics, checks))
