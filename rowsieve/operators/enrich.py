"""Lookup enrichment."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.functions import column, int_value

MATCHED = "_matched"


def _keys(on: str | Sequence[str] | dict[str, str]) -> dict[str, str]:
    if isinstance(on, str):
        return {on: on}
    if isinstance(on, dict):
        return on
    return {name: name for name in on}


def _same_key(fact: DataFrame, side: DataFrame, keys: dict[str, str]) -> Column:
    tests = []
    for i, name in enumerate(keys):
        left, right = fact[f"`{name}`"], side[f"_key{i}"]
        left_type, right_type = fact.schema[name].dataType, side.schema[f"_key{i}"].dataType
        if isinstance(left_type, T.StringType) and not isinstance(right_type, T.StringType):
            left = _read_as(left, right_type)
        elif isinstance(right_type, T.StringType) and not isinstance(left_type, T.StringType):
            right = _read_as(right, left_type)
        tests.append(left == right)
    return reduce(lambda left, right: left & right, tests)


def _read_as(text: Column, kind: T.DataType) -> Column:
    """Key text as a value of the other side's type, null where it is none."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return int_value(text, big=True)
    return text.try_cast(kind)


def _side(lookup: DataFrame, keys: dict[str, str], added: list[Column]) -> DataFrame:
    own = [column(right).alias(f"_key{i}") for i, right in enumerate(keys.values())]
    return lookup.select(*own, *added)


def enrich(
    fact: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str] | dict[str, str],
    columns: Sequence[str],
    *,
    mark_unmatched: bool = False,
) -> DataFrame:
    """All columns of ``fact`` plus the named lookup columns, inner join on equality.

    A text key meets a typed one as a value of that type, and text that is none meets
    nothing. Rows whose key is null or not in the lookup are dropped; a key that the lookup
    holds twice yields its rows twice. With ``mark_unmatched`` nothing is dropped:
    ``_matched`` says which rows found a partner, so enriched and lost rows can be
    counted in one scan (filtering on it plans as the inner join again).

    No broadcast hint is set. The planner broadcasts the lookup while its size is
    below ``spark.sql.autoBroadcastJoinThreshold``, measured again at run time;
    beyond that it shuffles both sides and adaptive execution splits hot keys.
    """
    keys = _keys(on)
    clash = set(columns) & set(fact.columns)
    if clash:
        raise ValueError(f"the table already has {sorted(clash)}")
    added = [column(name).alias(name) for name in columns]
    if mark_unmatched:
        added.append(F.lit(True).alias(MATCHED))
    side = _side(lookup, keys, added)
    joined = fact.join(side, _same_key(fact, side, keys), "left" if mark_unmatched else "inner")
    kept = [side[f"`{name}`"] for name in columns]
    if mark_unmatched:
        kept.append(F.coalesce(side[MATCHED], F.lit(False)).alias(MATCHED))
    return joined.select(*[fact[f"`{name}`"] for name in fact.columns], *kept)


def unmatched(
    fact: DataFrame, lookup: DataFrame, on: str | Sequence[str] | dict[str, str]
) -> DataFrame:
    """Rows that enrichment drops, null keys included."""
    keys = _keys(on)
    side = _side(lookup, keys, [])
    return fact.join(side, _same_key(fact, side, keys), "left_anti")
