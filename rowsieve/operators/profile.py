"""Column profiles: one aggregate over all columns, then histograms of the small ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.functions import column, literal_rows, type_class
from rowsieve.functions.scalar import BOOLEAN_BIT, FRACTIONAL_BIT, INTEGRAL_BIT, STRING_BIT

UNKNOWN, FRACTIONAL, INTEGRAL = "Unknown", "Fractional", "Integral"
BOOLEAN, STRING = "Boolean", "String"

# The histogram's name for null, and the distinct count it stops at.
NULL_VALUE = "NullValue"
HISTOGRAM_THRESHOLD = 120


def _declared(data_type: T.DataType) -> str:
    """Profile type of a column that already has a type."""
    if isinstance(data_type, T.BooleanType):
        return BOOLEAN
    if isinstance(data_type, T.IntegralType):
        return INTEGRAL
    if isinstance(data_type, T.NumericType):
        return FRACTIONAL
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return STRING
    return UNKNOWN


def _inferred(classes: Column) -> Column:
    """Profile type from the set of text classes seen in a string column."""

    def seen(bit: int) -> Column:
        return classes.bitwiseAND(F.lit(bit)) != 0

    number = seen(INTEGRAL_BIT) | seen(FRACTIONAL_BIT)
    return (
        F.when(classes.isNull(), UNKNOWN)
        .when(seen(STRING_BIT) | (seen(BOOLEAN_BIT) & number), STRING)
        .when(seen(BOOLEAN_BIT), BOOLEAN)
        .when(seen(FRACTIONAL_BIT), FRACTIONAL)
        .otherwise(INTEGRAL)
    )


_STATISTICS = {"minimum": F.min, "maximum": F.max, "mean": F.avg, "std_dev": F.stddev_pop}


def profile_columns(
    df: DataFrame, *, rsd: float = 0.05, distinct: bool = True, statistics: bool = True
) -> DataFrame:
    """One row per column, from a single aggregate over the table.

    ``column, completeness, inferred_datatype``; with ``distinct`` also
    ``approx_distinct_values``; with ``statistics`` also ``minimum, maximum, mean,
    std_dev``, which are null unless the column is a number or text that is numeric
    throughout. Text is classed once per value and parsed as a number only where its
    class is numeric.
    """
    classed, numbered, aggregates, rows = [], [], [F.count(F.lit(1)).alias("n")], []
    for i, field in enumerate(df.schema):
        raw, kind, number = f"c{i}", f"t{i}", f"x{i}"
        is_text = isinstance(field.dataType, T.StringType)
        is_number = isinstance(field.dataType, T.NumericType)
        classed.append(column(field.name).alias(raw))
        aggregates.append(F.count(raw).alias(f"n{i}"))
        inferred = F.lit(_declared(field.dataType))
        if is_text:
            classed.append(type_class(column(field.name)).alias(kind))
            aggregates.append(F.bit_or(kind).alias(kind))
            inferred = _inferred(F.col(kind))
        facts = {
            "column": F.lit(field.name),
            "completeness": F.try_divide(F.col(f"n{i}"), F.col("n")),
            "inferred_datatype": inferred,
        }
        if distinct:
            # maps cannot be compared, so they have no distinct count
            comparable = "map<" not in field.dataType.simpleString()
            counted = F.approx_count_distinct(raw, rsd) if comparable else F.first(F.lit(None))
            aggregates.append(counted.cast("bigint").alias(f"d{i}"))
            facts["approx_distinct_values"] = F.col(f"d{i}")
        if statistics and is_text:
            is_numeric = F.col(kind).isin(INTEGRAL_BIT, FRACTIONAL_BIT)
            numbered.append(F.when(is_numeric, F.col(raw).try_cast("double")).alias(number))
        elif statistics and is_number:
            numbered.append(F.col(raw).cast("double").alias(number))
        for name, aggregate in _STATISTICS.items() if statistics else ():
            fact = F.lit(None).cast("double")
            if is_text or is_number:
                aggregates.append(aggregate(number).alias(f"{name}{i}"))
                fact = F.col(f"{name}{i}")
            facts[name] = F.when(inferred.isin(INTEGRAL, FRACTIONAL), fact) if is_text else fact
        rows.append(F.struct(*[fact.alias(name) for name, fact in facts.items()]))
    values = df.select(*classed).select("*", *numbered)
    return values.agg(*aggregates).select(F.inline(F.array(*rows)))


def profile_wide(
    df: DataFrame, *, rsd: float = 0.05, distinct: bool = True, statistics: bool = True
) -> DataFrame:
    """``profile_columns`` for tables of many columns: the same facts from one narrow aggregate.

    Every row becomes one (column number, value) entry per column, and entries are added up by
    column within each task before the shuffle. The plan has a handful of expressions however
    many columns there are, where one aggregate over all columns outgrows what can be compiled.
    """
    entries, named = [], []
    for i, field in enumerate(df.schema):
        value, kind = column(field.name), field.dataType
        is_text, is_number = isinstance(kind, T.StringType), isinstance(kind, T.NumericType)
        # maps cannot be compared, so they have no distinct count
        comparable = distinct and "map<" not in kind.simpleString()
        entries.append(
            F.struct(
                F.lit(i).alias("i"),
                value.isNotNull().alias("there"),
                (value if is_text else F.lit(None)).cast("string").alias("text"),
                (value if is_number and statistics else F.lit(None)).cast("double").alias("number"),
                (F.when(value.isNotNull(), F.xxhash64(value)) if comparable else F.lit(None).cast("bigint")).alias("code"),
            )
        )
        named.append((i, field.name, None if is_text else _declared(kind), comparable))
    long = df.select(F.inline(F.array(*entries))).withColumn("class", type_class(F.col("text")))
    if statistics:
        is_numeric = F.col("class").isin(INTEGRAL_BIT, FRACTIONAL_BIT)
        parsed = F.when(is_numeric, F.col("text").try_cast("double"))
        long = long.withColumn("number", F.coalesce("number", parsed))
    aggregates = [F.count(F.lit(1)).alias("n"), F.count_if("there").alias("there"), F.bit_or("class").alias("class")]
    if distinct:
        aggregates.append(F.approx_count_distinct("code", rsd).alias("distinct"))
    if statistics:
        aggregates += [aggregate("number").alias(name) for name, aggregate in _STATISTICS.items()]
    found = long.groupBy("i").agg(*aggregates)
    types = {"i": "int", "column": "string", "declared": "string", "comparable": "boolean"}
    rows = literal_rows(df.sparkSession, named, types).join(F.broadcast(found), "i", "left")
    is_text, inferred = F.col("declared").isNull(), F.coalesce("declared", _inferred(F.col("class")))
    facts = {
        "column": F.col("column"),
        "completeness": F.try_divide(F.col("there"), F.col("n")),
        "inferred_datatype": inferred,
    }
    if distinct:
        facts["approx_distinct_values"] = F.when(F.col("comparable"), F.coalesce("distinct", F.lit(0)).cast("bigint"))
    for name in _STATISTICS if statistics else ():
        facts[name] = F.when(~is_text | inferred.isin(INTEGRAL, FRACTIONAL), F.col(name))
    return rows.select(*[fact.alias(name) for name, fact in facts.items()])


def profile_table(profile: DataFrame, timestamp: int) -> DataFrame:
    """The short profile, stamped with the run's epoch seconds."""
    return profile.select(
        "column", "completeness", "inferred_datatype", "approx_distinct_values"
    ).withColumn("timestamp", F.lit(timestamp).cast("bigint"))


def low_cardinality_columns(profile: DataFrame, below: int = 50) -> DataFrame:
    """Names of the columns with fewer distinct values than ``below``."""
    return profile.where(F.col("approx_distinct_values") < below).select("column")


def histograms(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value counts of the named columns: ``column, value, absolute, ratio``.

    All columns go through one scan and one shuffle, which carries only the counts
    each task has already added up. The ratio is over all rows; its divisor comes
    from the same shuffled counts.
    """
    texts = [column(name).cast("string").alias(name) for name in columns]
    long = df.select(*texts).unpivot([], [f"`{name}`" for name in columns], "column", "value")
    counts = (
        long.groupBy("column", F.coalesce("value", F.lit(NULL_VALUE)).alias("value"))
        .agg(F.count(F.lit(1)).alias("absolute"))
    )
    totals = counts.groupBy("column").agg(F.sum("absolute").alias("rows"))
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", "absolute", (F.col("absolute") / F.col("rows")).alias("ratio")
    )
