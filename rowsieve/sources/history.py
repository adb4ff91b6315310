"""Metric history and run metrics as append-only tables.

A run puts its handful of rows in a folder of its own under its day and touches
nothing written before, so any number of jobs may write at the same time. Reading
prunes to the days asked for; the tag test is a residual filter on what is left.

Many runs are many small files. ``compact_history`` gathers them in a snapshot, one file a
day, and readers take snapshots and what came after them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.functions import day_of_millis, elapsed_seconds
from rowsieve.sources.files import exists, names_in, remove, rename

HISTORY_SCHEMA = (
    "entity string, instance string, name string, value double, "
    "dataset_date bigint, tags map<string,string>, written_at bigint, ds date, run string"
)

RUN_METRICS_SCHEMA = (
    "job string, metric string, help string, labels map<string,string>, value double, ts bigint, ds date, run string"
)

#: Where a history keeps its snapshots; file listings pass over the name.
SNAPSHOTS = "_snapshots"

# Names and help texts of the three gauges of a gate run.
VALID_ROWS_GAUGE = ("num_Valid_Rows_count", "Num of valid rows in dataset")
INVALID_ROWS_GAUGE = ("num_Invalid_Rows_count", "Num of invalid rows in dataset")
DURATION_GAUGE = ("job_total_duration_sec", "job duration")


@dataclass(frozen=True)
class ResultKey:
    """What identifies a run: its instant in epoch milliseconds and its tags."""

    dataset_date: int
    tags: Mapping[str, str] = field(default_factory=dict)


def with_key(metrics: DataFrame, key: ResultKey) -> DataFrame:
    pairs = [F.lit(part) for pair in sorted(key.tags.items()) for part in pair]
    tags = F.create_map(*pairs).cast("map<string,string>")
    return metrics.withColumns(
        {"dataset_date": F.lit(key.dataset_date).cast("bigint"), "tags": tags}
    )


def _append(rows: DataFrame, path: str, millis: int) -> str:
    """Write rows to a folder of their own, named so that later runs sort behind."""
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    folder = f"{path.rstrip('/')}/ds={day_of_millis(millis)}/run={run}"
    rows.coalesce(1).write.mode("errorifexists").parquet(folder)
    return folder


def append_metrics(
    metrics: DataFrame, path: str, key: ResultKey, *, written_at: int | None = None
) -> str:
    """Append metric rows ``entity, instance, name, value`` under a result key.

    ``written_at`` (epoch milliseconds, now by default) orders writes under one key:
    the latest value of a metric is the one read back, so repeating a run replaces its
    metrics. Writes of one instant are ordered by their run ids, which sort by the clock
    of the writer to the nanosecond. Returns the folder written.
    """
    keyed = with_key(metrics.select("entity", "instance", "name", "value"), key)
    written = time.time_ns() // 1_000_000 if written_at is None else written_at
    return _append(keyed.withColumn("written_at", F.lit(written).cast("bigint")), path, key.dataset_date)


def _runs(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the folders that runs have written and no compaction has removed."""
    return spark.read.schema(HISTORY_SCHEMA).parquet(path)


def _snapshots(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Each finished snapshot's rows, by its folder."""
    base = f"{path.rstrip('/')}/{SNAPSHOTS}"
    folders = [f"{base}/{name}" for name in names_in(spark, base) if not name.startswith("_")]
    return {folder: spark.read.schema(HISTORY_SCHEMA).parquet(folder) for folder in folders}


def compact_history(spark: SparkSession, path: str) -> int:
    """Gather all runs written so far in one snapshot; returns how many folders went.

    The snapshot gets its name when it is whole, and only then do the folders that it holds go,
    and older snapshots. A run that is written meanwhile is not in it and stays where it is; if
    the job ends in between, rows lie in two places and are read once. Rows keep
    their run and time of writing, so what replaces what does not change. A reader that listed a folder
    before it went must start again. One compaction at a time.
    """
    tail, older = _runs(spark, path), _snapshots(spark, path)
    done = tail.select("ds", "run").distinct().collect()
    if not done:
        return 0
    rows = reduce(DataFrame.unionByName, [tail, *older.values()])
    one = rows.dropDuplicates(["ds", "run", "entity", "instance", "name"])
    base, name = f"{path.rstrip('/')}/{SNAPSHOTS}", f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    one.repartition("ds").write.partitionBy("ds").parquet(f"{base}/_{name}")
    rename(spark, f"{base}/_{name}", f"{base}/{name}")
    gone = 0
    for row in done:
        folder = f"{path.rstrip('/')}/ds={row['ds']}/run={row['run']}"
        # A run whose write has not ended yet is left for the next time.
        if not exists(spark, f"{folder}/_temporary"):
            remove(spark, folder)
            gone += 1
    for folder in older:
        remove(spark, folder)
    return gone


def read_history(
    spark: SparkSession,
    path: str,
    *,
    tags: Mapping[str, str] | None = None,
    first_day: str | None = None,
    last_day: str | None = None,
) -> DataFrame:
    """Metrics of the runs that carry all the given tags, latest value per metric.

    Rows met both in a snapshot and in their run's folder count once, as the same write.
    """
    rows = reduce(DataFrame.unionByName, [_runs(spark, path), *_snapshots(spark, path).values()])
    if first_day is not None:
        rows = rows.where(F.col("ds") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        rows = rows.where(F.col("ds") <= F.lit(last_day).cast("date"))
    for tag, wanted in (tags or {}).items():
        rows = rows.where(F.col("tags")[tag] == wanted)
    return rows.groupBy("ds", "dataset_date", "tags", "entity", "instance", "name").agg(
        F.max_by("value", F.struct("written_at", "run")).alias("value")
    )


def success_metrics(history: DataFrame, tag_names: Sequence[str] = ()) -> DataFrame:
    """Metrics that have a value, with one column per named tag."""
    return history.where(F.col("value").isNotNull()).select(
        "entity",
        "instance",
        "name",
        "value",
        "dataset_date",
        *[F.col("tags")[tag].alias(tag) for tag in tag_names],
    )


def run_metrics(
    counts: DataFrame, *, job: str, dataset: str, start_millis: int, end_millis: int
) -> DataFrame:
    """Gauges of a gate run, one row each, from its ``num_valid_rows, num_invalid_rows`` row."""
    duration = elapsed_seconds(start_millis, end_millis)
    gauges = [
        (VALID_ROWS_GAUGE, F.col("num_valid_rows")),
        (INVALID_ROWS_GAUGE, F.col("num_invalid_rows")),
        (DURATION_GAUGE, duration),
    ]
    rows = [
        F.struct(
            F.lit(name).alias("metric"),
            F.lit(text).alias("help"),
            value.cast("double").alias("value"),
        )
        for (name, text), value in gauges
    ]
    return counts.select(F.inline(F.array(*rows))).select(
        F.lit(job).alias("job"),
        "metric",
        "help",
        F.create_map(F.lit("dataset"), F.lit(dataset)).alias("labels"),
        "value",
        F.lit(end_millis).cast("bigint").alias("ts"),
    )


def append_run_metrics(gauges: DataFrame, path: str, *, end_millis: int) -> None:
    """Append the gauges of a run that ended at this instant."""
    _append(gauges, path, end_millis)


def read_run_metrics(
    spark: SparkSession, path: str, *, first_day: str | None = None, last_day: str | None = None
) -> DataFrame:
    """Gauges of all runs whose end lies within the days asked for."""
    rows = spark.read.schema(RUN_METRICS_SCHEMA).parquet(path)
    if first_day is not None:
        rows = rows.where(F.col("ds") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        rows = rows.where(F.col("ds") <= F.lit(last_day).cast("date"))
    return rows
