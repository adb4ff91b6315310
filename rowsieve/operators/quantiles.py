"""Exact quantiles by narrowing: no sort, no task that holds a column.

A quantile summary brackets the wanted rank; the next scan counts the rows up to
the bracket and summarises only those inside it. Each scan leaves less than a
hundredth of the rows, so a few suffice, and what ends in one task is a bounded
remainder. The driver sees one small row per scan. Ranks are counted, never
estimated: where a summary misses, the next scan looks on the side it missed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsieve.functions import cases, column, literal_rows

GRID = 1000
ACCURACY = 1000

_RESULT_TYPES = {"column": "string", "quantile": "double", "value": "double"}


@dataclass(eq=False)
class _Search:
    """Search for one quantile; the answer is ``low``, ``high`` or strictly between."""

    column: str
    quantile: float
    low: object = None
    high: object = None
    wider: tuple = (None, None)
    rank: int | None = None
    before: int = 0
    inside: int | None = None
    value: object = None
    done: bool = False

    def between(self) -> Column:
        col = column(self.column)
        test = col.isNotNull()
        if self.low is not None:
            test = test & (col > F.lit(self.low))
        if self.high is not None:
            test = test & (col < F.lit(self.high))
        return test

    def aggregates(self) -> dict[str, Column]:
        col, none = column(self.column), F.lit(False)
        low = none if self.low is None else col < F.lit(self.low)
        at_low = none if self.low is None else col == F.lit(self.low)
        at_high = none if self.high is None else col == F.lit(self.high)
        fractions = [i / GRID for i in range(GRID + 1)]
        return {
            "low": F.count_if(low),
            "at_low": F.count_if(at_low),
            "inside": F.count_if(self.between()),
            "at_high": F.count_if(at_high),
            "grid": F.percentile_approx(F.when(self.between(), col), fractions, ACCURACY),
        }

    def found(self, value: object) -> None:
        self.value, self.done = value, True

    def narrow(self, seen: dict) -> None:
        if self.rank is None:
            if seen["inside"] == 0:
                return self.found(None)
            # as the decimal that was written, since 0.07 * 100 is above 7 in floating point
            self.rank = max(1, math.ceil(Fraction(str(self.quantile)) * seen["inside"]))
        position = self.rank - seen["low"]
        if position <= 0:
            self.low, self.high, self.inside = self.wider[0], self.low, None
            return None
        if position <= seen["at_low"]:
            return self.found(self.low)
        position -= seen["at_low"]
        if position <= seen["inside"]:
            self.before, self.inside = self.rank - position, seen["inside"]
            return self._bracket(position / seen["inside"], seen["grid"])
        if position <= seen["inside"] + seen["at_high"]:
            return self.found(self.high)
        self.low, self.high, self.inside = self.high, self.wider[1], None
        return None

    def _bracket(self, share: float, grid: list) -> None:
        slack = 2 / ACCURACY
        first, last = math.floor((share - slack) * GRID), math.ceil((share + slack) * GRID)
        self.wider = (self.low, self.high)
        self.low = self.low if first <= 0 else grid[first]
        self.high = self.high if last >= GRID else grid[last]


def _settle(table: DataFrame, searches: list[_Search]) -> None:
    """Find the rank in each last counted bracket by running counts, all in one scan."""
    for search in searches:
        search.low, search.high = search.wider
    # Rows outside all brackets go before the rest is laid out once per search.
    inside = reduce(lambda a, b: a | b, [s.between() for s in searches])
    picked = table.where(inside).select(
        *[
            F.when(s.between(), column(s.column)).cast("double").alias(str(i))
            for i, s in enumerate(searches)
        ]
    )
    values = (
        picked.unpivot([], picked.columns, "search", "v")
        .where(F.col("v").isNotNull())
        .groupBy("search", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("search").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    wanted = cases((F.col("search") == str(i), s.rank - s.before) for i, s in enumerate(searches))
    reached = values.select("search", "v", F.sum("n").over(order).alias("upto"))
    answers = reached.where(F.col("upto") >= wanted).groupBy("search").agg(F.min("v").alias("v"))
    for row in answers.collect():
        searches[int(row["search"])].found(row["v"])


def exact_quantiles(
    df: DataFrame, targets: Sequence[tuple[str, float]], *, settle_rows: int = 100_000
) -> DataFrame:
    """``column, quantile, value``: the smallest value whose cumulative share reaches it.

    Numeric columns; null on a column without values. Searches share their scans,
    which read only the searched columns. At most ``settle_rows`` rows per search are
    ever ordered in one task; that number decides how often a bracket is narrowed, not
    what is found.
    """
    searches = [_Search(name, quantile) for name, quantile in targets]
    table = df.select(*[column(name) for name in dict.fromkeys(name for name, _ in targets)])
    small: list[_Search] = []
    while wide := [search for search in searches if not search.done and search not in small]:
        row = table.agg(
            *[
                F.struct(*[part.alias(key) for key, part in search.aggregates().items()]).alias(
                    f"s{i}"
                )
                for i, search in enumerate(wide)
            ]
        ).first()
        for search, seen in zip(wide, row):
            search.narrow(seen.asDict())
            if not search.done and search.inside is not None and search.inside <= settle_rows:
                small.append(search)
    if small:
        _settle(table, small)
    rows = [
        (s.column, s.quantile, None if s.value is None else float(s.value)) for s in searches
    ]
    return literal_rows(df.sparkSession, rows, _RESULT_TYPES)
