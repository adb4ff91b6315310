"""A look at a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def preview(df: DataFrame, rows: int = 10, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """The first rows, in the given order if there is one: no full sort, no full scan without."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)
