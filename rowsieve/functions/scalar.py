"""Scalar expressions: casts that never throw, masks, shares, type classes.

Spark 4 runs in ANSI mode, where a plain cast or division fails the whole job on
the first bad value. Checking tables is about bad values, so everything here uses
the ``try_`` family and yields null instead.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numbers as text, and the blanks around them that a cast skips.
BLANKS = r"[\x00-\x20\x7f]*"
NUMBER = r"[+-]?(?:\d++(?:\.\d*+)?+|\.\d++)(?:[eE][+-]?\d++)?+"
NUMBER_TEXT = rf"^{NUMBER}\z"
PADDED_NUMBER_TEXT = rf"^{BLANKS}{NUMBER}{BLANKS}\z"
BOOLEAN_TEXT = ("true", "false")

# The plain fields of a date mask, and the day mask with its usual text.
MASK_FIELDS = {
    "yyyy": r"[+-]?\d{4,}",
    "MM": r"\d{2}",
    "dd": r"\d{2}",
    "HH": r"\d{2}",
    "mm": r"\d{2}",
    "ss": r"\d{2}",
}
ISO_DAY = "yyyy-MM-dd"
ISO_DAY_TEXT = r"^\d{4}-\d{2}-\d{2}\z"

# One bit per class, so that bit_or over a column says which classes occur in it.
STRING_BIT, BOOLEAN_BIT, FRACTIONAL_BIT, INTEGRAL_BIT = 8, 4, 2, 1


def column(name: str) -> Column:
    """The column of exactly this name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def cases(pairs: Iterable[tuple[Column, Column | object]]) -> Column:
    """The value of the first condition that holds, null where none does."""
    (condition, value), *others = pairs
    chain = F.when(condition, value)
    for condition, value in others:
        chain = chain.when(condition, value)
    return chain


def column_label(expression: Column) -> str:
    """Readable text of an expression, for reports."""
    text = str(expression).removeprefix("Column<'").removesuffix("'>")
    comparison = re.fullmatch(r"([=<>!]+)\((\w+), ([^()]+)\)", text)
    return "{1} {0} {2}".format(*comparison.groups()) if comparison else text


def share_of(predicate: Column) -> Column:
    """Aggregate: share of rows that satisfy the predicate, null on an empty table.

    A row whose predicate is null does not satisfy it.
    """
    return F.try_divide(F.count_if(predicate), F.count(F.lit(1)))


def int_value(col: Column, *, big: bool = False, fractions: str = "reject") -> Column:
    """Integer value of a column, null where it has none.

    ``fractions="truncate"`` takes 12.7 as 12, in text as in a number; ``"reject"``
    gives null for it. Columns that hold neither text nor numbers have no integer value.

    A cast that fails costs as much as a hundred that succeed, also under ``try_cast``.
    So text is cast only where its shape says that the cast can succeed, and a column
    full of bad values is as fast as a good one.
    """
    if fractions not in ("reject", "truncate"):
        raise ValueError(f"fractions must be 'reject' or 'truncate', not {fractions!r}")
    text = col.cast("string")
    if fractions == "truncate":
        text = F.regexp_extract(text, rf"^{BLANKS}([+-]?\d+)(?:\.\d*)?{BLANKS}\z", 1)
    target, digits = ("bigint", 19) if big else ("int", 10)
    # Text one digit short of the type's longest always fits; the rest needs a closer look.
    is_short = text.rlike(rf"^[+-]?\d{{1,{digits - 1}}}\z")
    has_shape = text.rlike(rf"^{BLANKS}[+-]?0*\d{{1,{digits}}}{BLANKS}\z")
    longest = text.try_cast("bigint")
    if not big:
        longest = F.when(longest.between(-(2**31), 2**31 - 1), longest).cast("int")
    from_text = F.when(is_short, text.try_cast(target)).when(has_shape, longest)
    kind, typed = F.typeof(col), col.try_cast(target)
    if fractions == "reject":
        exact = typed.cast("decimal(38,10)") == col.try_cast("decimal(38,10)")
        typed = F.when(kind.isin("tinyint", "smallint", "int", "bigint") | exact, typed)
    numbers = kind.isin("tinyint", "smallint", "int", "bigint", "float", "double")
    typed = F.when(numbers | kind.startswith("decimal"), typed)
    return F.when(kind == "string", from_text).otherwise(typed)


def number_value(col: Column, data_type: T.DataType) -> Column:
    """Double value of a column; null for text that is no plain number."""
    if isinstance(data_type, T.StringType):
        return F.when(col.rlike(PADDED_NUMBER_TEXT), col.try_cast("double"))
    return col.cast("double")


def mask_shape(mask: str) -> str | None:
    """Pattern that all text under a mask of plain fields meets; None for other masks."""
    shape = ""
    for part in re.findall(r"[A-Za-z]+|[^A-Za-z]+", mask):
        if part in MASK_FIELDS:
            shape += MASK_FIELDS[part]
        elif part[0].isalpha() or set(part) & set("'[]{}#"):
            return None
        else:
            shape += re.escape(part)
    return rf"^{shape}\z"


def masked_timestamp(col: Column, mask: str) -> Column:
    """Timestamp read by a date mask, null where the text does not fit it.

    The mask parser is slow to fail, so text is shown to it only in the mask's shape.
    Text under the plain day mask is read as a date, which is quicker still. Which
    way is taken depends on the column's type and is settled when the plan is made.
    """
    by_mask, shape = F.try_to_timestamp(col, F.lit(mask)), mask_shape(mask)
    if shape is None:
        return by_mask
    text = col.cast("string")
    from_text = F.when(text.rlike(shape), by_mask)
    if mask == ISO_DAY:
        by_cast = text.try_cast("date").cast("timestamp")
        from_text = F.when(text.rlike(ISO_DAY_TEXT), by_cast).when(text.rlike(shape), by_mask)
    return F.when(F.typeof(col) == "string", from_text).otherwise(by_mask)


def pattern_found(col: Column, pattern: str, *, full_match: bool = False) -> Column:
    """True where the pattern finds non-empty text; ``full_match`` wants the whole value.

    Without ``full_match`` this is a search, so ``N|Y`` finds its Y in ``XNY``. An
    empty match counts as none, in both forms.
    """
    if full_match:
        return col.rlike(rf"\A(?:{pattern})\z") & (col != "")
    return F.regexp_extract(col, pattern, 0) != ""


def non_negative(col: Column, data_type: T.DataType) -> Column:
    """True where the value is null, not a number, or at least zero.

    Numbers compare as they are. Text is judged by what it says, however large or small:
    a number is negative if it has a minus and a digit other than zero before its exponent.
    """
    if isinstance(data_type, T.NumericType):
        return col.isNull() | (col >= 0)
    text = col.cast("string")
    negative = (
        F.contains(text, F.lit("-"))
        & text.rlike(PADDED_NUMBER_TEXT)
        & text.rlike(rf"^{BLANKS}-[0.]*[1-9]")
    )
    return ~F.coalesce(negative, F.lit(False))


def type_class(col: Column) -> Column:
    """Bit of the text class of a string value; null for null.

    Numbers start with a sign, a point or a digit, so other text meets no pattern.
    """
    may_be_number = F.ascii(col).between(ord("+"), ord("9"))
    point, small, large = (F.contains(col, F.lit(mark)) for mark in ".eE")
    has_fraction = point | small | large
    return (
        F.when(col.isNull(), F.lit(None).cast("int"))
        .when(
            may_be_number & col.rlike(NUMBER_TEXT),
            F.when(has_fraction, F.lit(FRACTIONAL_BIT)).otherwise(F.lit(INTEGRAL_BIT)),
        )
        .when(col.isin(*BOOLEAN_TEXT), F.lit(BOOLEAN_BIT))
        .otherwise(F.lit(STRING_BIT))
    )


def day_of_millis(millis: int) -> str:
    """UTC day of an epoch-millisecond instant."""
    return (dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=millis)).date().isoformat()


def elapsed_seconds(start_millis: int | Column, end_millis: int | Column) -> Column:
    """Whole seconds between two instants, each cut to its second first."""

    def seconds(millis: int | Column) -> Column:
        value = millis if isinstance(millis, Column) else F.lit(millis)
        return F.floor(value.cast("bigint") / F.lit(1000)).cast("bigint")

    return seconds(end_millis) - seconds(start_millis)


def file_stamp(instant: str | Column) -> str | Column:
    """Instant text without colons, safe in a file name."""
    if isinstance(instant, Column):
        return F.replace(instant, F.lit(":"), F.lit(""))
    return instant.replace(":", "")


def literal_rows(
    spark: SparkSession, rows: Sequence[Sequence[object]], types: dict[str, str]
) -> DataFrame:
    """A few rows of metadata (rules, constraints, gauges) as a one-partition table.

    They are literals of the plan, so nothing is shipped from Python workers and no
    task is started per core for a handful of rows. ``types`` names each column's type.
    """
    one = spark.range(0, 1, 1, 1)
    if not rows:
        nothing = [F.lit(None).cast(kind).alias(name) for name, kind in types.items()]
        return one.where(F.lit(False)).select(*nothing)
    structs = [
        F.struct(*[F.lit(x).cast(kind).alias(name) for x, (name, kind) in zip(row, types.items())])
        for row in rows
    ]
    return one.select(F.inline(F.array(*structs)))
