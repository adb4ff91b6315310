"""The jobs a user runs: a gate, a verification, a profile.

The gate computes its source once and reads it back from a staging table. A verification
scans its source once for scan metrics and once for uniqueness, if asked for; a profile
once for the columns and once for histograms. Stage a source first if that costs a join.

Staging tables are written to shared storage, so a lost executor costs the tasks it
was running and nothing else: no job here depends on cached blocks.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rowsieve.functions import literal_rows
from rowsieve.operators.checks import Check, Verification, evaluate, required_metrics
from rowsieve.operators.metrics import compute_metrics
from rowsieve.operators.profile import HISTOGRAM_THRESHOLD, histograms, profile_columns
from rowsieve.operators.rules import FAILED, IS_VALID, RowSchema
from rowsieve.sources.history import (
    ResultKey,
    append_metrics,
    append_run_metrics,
    run_metrics,
)
from rowsieve.sources.publication import new_run, publish, published
from rowsieve.sources.scratch import discard, fresh_path
from rowsieve.sources.sinks import (
    write_invalid_csv,
    write_profile_json,
    write_valid_csv,
    write_valid_orc,
)

_COUNTS_TYPES = {"num_valid_rows": "bigint", "num_invalid_rows": "bigint"}


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the length of one write.

    Jobs that run in the same session at that time see it too; one that minds takes a
    session of its own (``newSession``).
    """
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@dataclass(frozen=True)
class GateOutcome:
    num_valid_rows: int
    num_invalid_rows: int
    valid_orc: str
    valid_csv: str
    invalid_csv: str
    gauges: DataFrame


def run_gate(
    df: DataFrame,
    schema: RowSchema,
    out_dir: str,
    name: str,
    *,
    dataset: str,
    reasons: bool = False,
    metrics_path: str | None = None,
    start_millis: int | None = None,
    end_millis: int | None = None,
) -> GateOutcome:
    """Check every row, write valid rows as ORC and CSV and invalid ones to quarantine.

    The source (with whatever join made it) is computed once: flagged rows go to a
    Parquet staging table partitioned by outcome, counted on the way, and the outputs
    read their partition of it. Since nothing is overwritten before staging
    is complete, an output may even replace the source. The staging table is removed
    at the end.
    """
    spark = df.sparkSession
    started = time.time_ns() // 1_000_000 if start_millis is None else start_millis
    counted = Observation()
    flagged = schema.flag(df).observe(
        counted,
        F.count_if(F.col(IS_VALID)).alias("valid"),
        F.count_if(~F.col(IS_VALID)).alias("invalid"),
    )
    if not reasons:
        flagged = flagged.drop(FAILED)
    staging = fresh_path(spark, f"{name}-staging")
    # One open file per outcome and task; otherwise each task sorts its rows by outcome first.
    try:
        with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "2"):
            flagged.write.partitionBy(IS_VALID).parquet(staging)
        staged = spark.read.schema(flagged.schema).parquet(staging)
        valid = schema.typed(staged.where(F.col(IS_VALID)))
        invalid = schema.untyped(staged.where(~F.col(IS_VALID)), reasons=reasons)
        valid_orc = write_valid_orc(valid, out_dir, name)
        # The ORC rows are typed already, so the CSV need not parse every value again.
        valid_csv = write_valid_csv(spark.read.schema(valid.schema).orc(valid_orc), out_dir, name)
        invalid_csv = write_invalid_csv(invalid, out_dir, name)
    finally:
        discard(spark, staging)

    num_valid, num_invalid = counted.get["valid"], counted.get["invalid"]
    counts = literal_rows(spark, [(num_valid, num_invalid)], _COUNTS_TYPES)
    ended = time.time_ns() // 1_000_000 if end_millis is None else end_millis
    gauges = run_metrics(counts, job=name, dataset=dataset, start_millis=started, end_millis=ended)
    if metrics_path is not None:
        append_run_metrics(gauges, metrics_path, end_millis=ended)
    return GateOutcome(num_valid, num_invalid, valid_orc, valid_csv, invalid_csv, gauges)


def run_published_gate(
    df: DataFrame,
    schema: RowSchema,
    out_dir: str,
    name: str,
    *,
    metrics_path: str | None = None,
    end_millis: int | None = None,
    **options: object,
) -> GateOutcome:
    """``run_gate`` whose three outputs replace those of the run before all at once.

    Outputs lie under ``out_dir/name``, a folder per run; ``published_gate`` tells the current
    ones. If a write fails, those of the run before stay current and whole.
    """
    base = f"{out_dir.rstrip('/')}/{name}"
    done = run_gate(df, schema, new_run(base), name, end_millis=end_millis, **options)
    publish(
        df.sparkSession,
        base,
        {"valid_orc": done.valid_orc, "valid_csv": done.valid_csv, "invalid_csv": done.invalid_csv},
    )
    if metrics_path is not None:
        ended = time.time_ns() // 1_000_000 if end_millis is None else end_millis
        append_run_metrics(done.gauges, metrics_path, end_millis=ended)
    return done


def published_gate(spark: SparkSession, out_dir: str, name: str) -> dict[str, str]:
    """Paths of the current outputs of a published gate: valid_orc, valid_csv, invalid_csv."""
    return published(spark, f"{out_dir.rstrip('/')}/{name}")


def run_verification(
    df: DataFrame, checks: Sequence[Check], history_path: str, key: ResultKey
) -> Verification:
    """Append the checks' metrics to the history and judge the rows just written.

    Only this run's own folder is read back, whatever else is written under its key and
    however long the history is.
    """
    computed = compute_metrics(df, required_metrics(checks))
    folder = append_metrics(computed, history_path, key)
    stored = df.sparkSession.read.schema(computed.schema).parquet(folder)
    metrics = stored.select("entity", "instance", "name", "value")
    return Verification(metrics, evaluate(metrics, checks))


@dataclass(frozen=True)
class ProfileOutcome:
    profile: DataFrame
    histograms: DataFrame | None
    profile_json: str
    histogram_json: str | None


def run_profile(
    df: DataFrame,
    out_dir: str,
    dataset: str,
    instant: str,
    *,
    threshold: int = HISTOGRAM_THRESHOLD,
) -> ProfileOutcome:
    """Profile all columns, then count the values of the low-cardinality ones; save both.

    Each pass is saved and read back, so looking at it again costs nothing. Which
    columns get a histogram depends on the first: the driver fetches one name per
    such column.
    """
    spark, profile = df.sparkSession, profile_columns(df)
    profile_json = write_profile_json(profile, out_dir, dataset, instant)
    saved = spark.read.schema(profile.schema).json(profile_json)
    small = saved.where(F.col("approx_distinct_values") <= threshold).select("column")
    names = {row["column"] for row in small.collect()}
    ordered = [name for name in df.columns if name in names]
    if not ordered:
        return ProfileOutcome(saved, None, profile_json, None)
    values = histograms(df, ordered)
    histogram_json = write_profile_json(values, out_dir, dataset, instant, part="_histograms")
    return ProfileOutcome(
        saved, spark.read.schema(values.schema).json(histogram_json), profile_json, histogram_json
    )
