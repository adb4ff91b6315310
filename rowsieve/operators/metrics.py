"""Table metrics, all that one pass can give from one pass.

``compute_metrics`` takes any list of metrics, drops repeats and plans

* one aggregate with a column per scan metric, reading only the columns in use;
* one frequency pass for all uniqueness keys together: each key is a grouping set,
  so the table is scanned and shuffled once, however many keys there are, and equal
  keys are already added up before the shuffle (a hot key sends one row per task).

Both end in one row, which is unfolded to ``entity, instance, name, value``.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.functions import cases, column, int_value, non_negative, number_value, share_of


@dataclass(frozen=True)
class Size:
    """Number of rows."""

    entity, instance, name = "Dataset", "*", "Size"

    def aggregate(self, schema: T.StructType) -> Column:
        return F.count(F.lit(1))


@dataclass(frozen=True)
class Completeness:
    """Share of rows where the column is not null."""

    column: str
    entity, name = "Column", "Completeness"

    @property
    def instance(self) -> str:
        return self.column

    def aggregate(self, schema: T.StructType) -> Column:
        return F.try_divide(F.count(column(self.column)), F.count(F.lit(1)))


@dataclass(frozen=True)
class Compliance:
    """Share of rows that satisfy a SQL predicate."""

    instance: str
    predicate: str
    entity, name = "Column", "Compliance"

    def aggregate(self, schema: T.StructType) -> Column:
        return share_of(F.expr(self.predicate))


@dataclass(frozen=True)
class Containment:
    """Share of rows whose value is null or in a given set.

    Between text and another type, the text is read as the other; text that cannot be
    is in no set.
    """

    column: str
    values: tuple
    entity, name = "Column", "Compliance"

    @property
    def instance(self) -> str:
        return f"{self.column} contained in {','.join(map(str, self.values))}"

    def aggregate(self, schema: T.StructType) -> Column:
        col, kind, values = column(self.column), schema[self.column].dataType, list(self.values)
        if isinstance(kind, T.StringType):
            if values and not any(isinstance(v, str) for v in values):
                whole = all(isinstance(v, int) and not isinstance(v, bool) for v in values)
                typed = int_value(col, big=True) if whole else number_value(col, kind)
                return share_of(col.isNull() | typed.isin(*values))
            values = [str(v) for v in values]
        elif any(isinstance(v, str) for v in values):
            # Text that is no value of the column's type is null, which nothing equals.
            values = [F.lit(v).try_cast(kind) if isinstance(v, str) else F.lit(v) for v in values]
        return share_of(col.isNull() | col.isin(*values))


@dataclass(frozen=True)
class NonNegative:
    """Share of rows whose value is null, not a number, or at least zero."""

    column: str
    entity, name = "Column", "Compliance"

    @property
    def instance(self) -> str:
        return f"{self.column} is non-negative"

    def aggregate(self, schema: T.StructType) -> Column:
        return share_of(non_negative(column(self.column), schema[self.column].dataType))


@dataclass(frozen=True)
class ApproxQuantile:
    """Value whose rank is within ``1/accuracy`` of the quantile; no interpolation.

    Every scan task sends a summary of about ``accuracy`` values to the final task,
    so accuracy times tasks has to stay moderate. ``exact_quantiles`` has no such
    bound.
    """

    column: str
    quantile: float
    accuracy: int = 1000
    entity = "Column"

    @property
    def instance(self) -> str:
        return self.column

    @property
    def name(self) -> str:
        return f"ApproxQuantile-{self.quantile}"

    def aggregate(self, schema: T.StructType) -> Column:
        col, data_type = column(self.column), schema[self.column].dataType
        if isinstance(data_type, T.StringType):
            col = number_value(col, data_type)
        return F.percentile_approx(col, F.lit(self.quantile), self.accuracy)


@dataclass(frozen=True)
class ApproxDistinct:
    """Approximate number of distinct non-null values."""

    column: str
    rsd: float = 0.05
    entity, name = "Column", "ApproxCountDistinct"

    @property
    def instance(self) -> str:
        return self.column

    def aggregate(self, schema: T.StructType) -> Column:
        return F.approx_count_distinct(column(self.column), self.rsd)


@dataclass(frozen=True)
class _Statistic:
    column: str
    entity = "Column"

    @property
    def instance(self) -> str:
        return self.column

    def number(self, schema: T.StructType) -> Column:
        return number_value(column(self.column), schema[self.column].dataType)


@dataclass(frozen=True)
class Minimum(_Statistic):
    name = "Minimum"

    def aggregate(self, schema: T.StructType) -> Column:
        return F.min(self.number(schema))


@dataclass(frozen=True)
class Maximum(_Statistic):
    name = "Maximum"

    def aggregate(self, schema: T.StructType) -> Column:
        return F.max(self.number(schema))


@dataclass(frozen=True)
class Mean(_Statistic):
    name = "Mean"

    def aggregate(self, schema: T.StructType) -> Column:
        return F.avg(self.number(schema))


@dataclass(frozen=True)
class StandardDeviation(_Statistic):
    """Population standard deviation."""

    name = "StandardDeviation"

    def aggregate(self, schema: T.StructType) -> Column:
        return F.stddev_pop(self.number(schema))


@dataclass(frozen=True)
class Uniqueness:
    """Share of rows whose key occurs exactly once; rows with a wholly null key stay out.

    ``digest=True`` groups on the SHA-256 of the key instead of the key, so that wide
    text keys shuffle 32 bytes each.
    """

    columns: tuple[str, ...]
    digest: bool = False
    name = "Uniqueness"

    @property
    def entity(self) -> str:
        return "Column" if len(self.columns) == 1 else "Multicolumn"

    @property
    def instance(self) -> str:
        return ",".join(self.columns)

    def keys(self) -> list[Column]:
        cols = [column(name) for name in self.columns]
        if not self.digest:
            return cols
        return [F.unhex(F.sha2(col.cast("string").cast("binary"), 256)) for col in cols]


def identity(metric) -> tuple[str, str, str]:
    return metric.entity, metric.instance, metric.name


def _distinct(metrics: Iterable) -> list:
    found: dict[tuple[str, str, str], object] = {}
    for metric in metrics:
        if found.setdefault(identity(metric), metric) != metric:
            raise ValueError(f"{identity(metric)} is asked for in two ways")
    return list(found.values())


def _unfold(row: DataFrame, metrics: list) -> DataFrame:
    """One wide row to a row per metric; ``row`` has its values as v0, v1, …"""
    structs = [
        F.struct(
            F.lit(metric.entity).alias("entity"),
            F.lit(metric.instance).alias("instance"),
            F.lit(metric.name).alias("name"),
            F.col(f"v{i}").cast("double").alias("value"),
        )
        for i, metric in enumerate(metrics)
    ]
    return row.select(F.inline(F.array(*structs)))


def _scan_row(df: DataFrame, metrics: list) -> DataFrame:
    return df.agg(*[metric.aggregate(df.schema).alias(f"v{i}") for i, metric in enumerate(metrics)])


def frequencies(df: DataFrame, keys: list[list[Column]]) -> DataFrame:
    """Counts of every value of every key: ``key_no, occurrences``, one scan, one shuffle.

    Rows whose key columns are all null are left out.
    """
    flat = [(i, col) for i, cols in enumerate(keys) for col in cols]
    names = [f"k{j}" for j in range(len(flat))]
    sets = [[n for n, (owner, _) in zip(names, flat) if owner == i] for i in range(len(keys))]
    table = df.select(*[col.alias(name) for name, (_, col) in zip(names, flat)])

    def some_value(members: list[str]) -> Column:
        return reduce(lambda a, b: a | b, [F.col(name).isNotNull() for name in members])

    if len(keys) == 1:
        counted = table.where(some_value(names)).groupBy(*names).agg(
            F.count(F.lit(1)).alias("occurrences")
        )
        return counted.select(F.lit(0).alias("key_no"), "occurrences")

    counted = table.groupingSets(sets, *names).agg(
        F.count(F.lit(1)).alias("occurrences"), F.grouping_id().alias("set_id")
    )
    # grouping_id has a bit per column, first column highest, set where the column is left out.
    everything = 2 ** len(names) - 1

    def is_mine(members: list[str]) -> Column:
        used = sum(2 ** (len(names) - 1 - names.index(name)) for name in members)
        return (F.col("set_id") == everything - used) & some_value(members)

    key_no = cases((is_mine(members), i) for i, members in enumerate(sets))
    return counted.select(key_no.alias("key_no"), "occurrences").where("key_no is not null")


def _uniqueness_row(df: DataFrame, metrics: list[Uniqueness]) -> DataFrame:
    counts = frequencies(df, [metric.keys() for metric in metrics])
    shares = []
    for i, _ in enumerate(metrics):
        mine = F.col("key_no") == i
        once = F.count_if(mine & (F.col("occurrences") == 1))
        rows = F.sum(F.when(mine, F.col("occurrences")))
        shares.append(F.try_divide(once, rows).alias(f"v{i}"))
    return counts.agg(*shares)


def compute_metrics(df: DataFrame, metrics: Iterable) -> DataFrame:
    """``entity, instance, name, value``; the value is null where no row gives one."""
    wanted = _distinct(metrics)
    if not wanted:
        raise ValueError("no metrics asked for")
    unique = [metric for metric in wanted if isinstance(metric, Uniqueness)]
    scanned = [metric for metric in wanted if not isinstance(metric, Uniqueness)]
    parts = []
    if scanned:
        parts.append(_unfold(_scan_row(df, scanned), scanned))
    # grouping_id is 64 bits wide, so very many key columns go in several passes.
    batch, width = [], 0
    for metric in unique:
        if batch and width + len(metric.columns) > 60:
            parts.append(_unfold(_uniqueness_row(df, batch), batch))
            batch, width = [], 0
        batch.append(metric)
        width += len(metric.columns)
    if batch:
        parts.append(_unfold(_uniqueness_row(df, batch), batch))
    return reduce(DataFrame.unionAll, parts)
