"""Integer range source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

INT_MAX = 2**31 - 1


def integer_range(
    spark: SparkSession, end: int, slices: int, *, start: int = 1, clamp: bool = False
) -> DataFrame:
    """Column ``id`` with start … end-1 in ``slices`` partitions.

    ``clamp=True`` holds the end to the largest 32-bit integer, and drops ids beyond.
    """
    return spark.range(start, min(end, INT_MAX) if clamp else end, 1, slices)
