"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows fall into source blocks by a hash of their key. The matrix that says how many rows
of each block go to each shard is drawn from the law that a uniform shuffle would give
it: block by block, the shard counts follow a multivariate hypergeometric law over the
places that are left. Within a block rows are ordered at random and dealt out by the
matrix; after the exchange each shard is ordered at random again. Shard sizes are
exact (``rows`` law: at most one apart), each assignment is equally likely, and no task
holds a whole block or shard: both orders run over ranges of the random key, whose counts
give each range its first place, so more rows mean more ranges, not larger ones.

All random numbers derive from the seed and the row's key, so a task that runs again
deals the same rows to the same places. Only DataFrame functions touch the rows; what
the driver draws is the matrix, one small row of numbers per block.

Null keys and texts are rows like others, and rows with equal ids and texts are told apart by
a number, given task by task. Null text has no bytes. An empty table gives an empty
result. Extra columns are dropped.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsieve.functions import literal_rows
from rowsieve.llm._shared import join_by, staged, text_of

#: Rows that a block or a range of a shard holds on average.
BLOCK_ROWS = 20_000
#: The matrix, which the driver draws, has at most so many blocks; beyond, blocks hold more ranges each.
MOST_BLOCKS = 4096


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` from ``good + bad`` places are good; exact at any size.

    Inverts the distribution over twelve deviations around its mode: what lies
    outside weighs less than the double's precision.
    """
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    mean = draws * good / total
    spread = math.sqrt(max(mean * (bad / total) * (total - draws) / max(total - 1, 1), 0.25))
    low = max(low, math.floor(mean - 12 * spread - 12))
    high = min(high, math.ceil(mean + 12 * spread + 12))
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log((good - k) * (draws - k)) - np.log((k + 1) * (bad - draws + k + 1))
    weight = np.concatenate([[0.0], np.cumsum(steps)])
    share = np.cumsum(np.exp(weight - weight.max()))
    return low + int(np.searchsorted(share, rng.random() * share[-1], side="right"))


def communication_matrix(rows: list[int], places: list[int], seed: int) -> list[list[int]]:
    """Counts from each block (``rows``) to each shard (``places``); both margins exact."""
    rng, left, matrix = np.random.default_rng(seed), list(places), []
    for count in rows:
        dealt, rest, open_places = [], count, sum(left)
        for free in left:
            open_places -= free
            taken = hypergeometric(rng, free, open_places, rest)
            dealt.append(taken)
            rest -= taken
        left = [free - taken for free, taken in zip(left, dealt)]
        matrix.append(dealt)
    return matrix


def _random_key(seed: int, stage: str, *keys: str) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(stage), *[F.col(k) for k in keys])


def _block(key: Column, blocks: int) -> Column:
    """The range of the 64-bit key: ``blocks`` equal parts in key order."""
    high = F.shiftrightunsigned(key.bitwiseXOR(F.lit(-(2**63))), 33)
    return F.floor(high * blocks / F.lit(2**31)).cast("int")


KEY = ("doc_id", "size", "text_crc32")


def _numbered(thin: DataFrame) -> DataFrame:
    """Rows with ``_copy``, from 1 on, among those that agree in all columns of ``KEY``.

    Such rows are interchangeable. They are counted for each task of the staged table first, so a
    task numbers no more of them than one has read, however many there are.
    """
    here = staged(thin.groupBy(*KEY, "_task").agg(F.count(F.lit(1)).alias("_n")), "equal-here")
    equal = here.groupBy(*KEY).agg(F.sum("_n").alias("_all")).where("_all > 1").select(*KEY)
    equal = staged(equal, "equal")
    if equal.isEmpty():
        return thin.withColumn("_copy", F.lit(1).cast("bigint"))
    earlier = Window.partitionBy(*KEY).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = join_by(here, equal, "left_semi", *KEY).withColumn(
        "_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    )
    within = Window.partitionBy(*KEY, "_task").orderBy("_task")
    several = join_by(thin, before.drop("_n"), "inner", *KEY, "_task")
    several = several.withColumn("_copy", F.row_number().over(within) + F.col("_before")).drop("_before")
    single = join_by(thin, equal, "left_anti", *KEY)
    return single.withColumn("_copy", F.lit(1).cast("bigint")).unionByName(several)


def _ranked(rows: DataFrame, group: str, part: str, key: str) -> DataFrame:
    """Rows with their place ``_at``, from 0 on, in their group in order of a random key.

    ``part`` numbers ranges of the key; each is ordered by itself, and the ranges' counts give each its
    first place."""
    parts = rows.groupBy(group, part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy(group, part).orderBy(key, *KEY, "_copy")
    placed = rows.withColumn("_within", F.row_number().over(within) - 1)
    return placed.join(starts, [group, part]).withColumn("_at", F.col("_first") + F.col("_within")).drop(
        "_first", "_within"
    )


def shard_rows(docs: DataFrame, shards: int = 16, seed: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot: a uniform shuffle into equal shards."""
    spark = docs.sparkSession
    thin = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text_of()) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(F.encode(text_of(), "UTF-8")).alias("text_crc32"),
    )
    thin = staged(thin.withColumn("_task", F.spark_partition_id()), "sizes")
    total = thin.count()
    blocks = min(MOST_BLOCKS, max(1, math.ceil(total / block_rows)))
    keyed = _numbered(thin).select(
        *KEY,
        "_copy",
        _random_key(seed, "deal", *KEY, "_copy").alias("_k1"),
        _random_key(seed, "slot", *KEY, "_copy").alias("_k2"),
    ).withColumn("_block", F.pmod(F.xxhash64("_k1"), F.lit(blocks)).cast("int"))
    keyed = keyed.withColumn("_part", _block(F.col("_k1"), max(1, math.ceil(total / blocks / block_rows))))
    keyed = staged(keyed, "keyed")

    counts = {r["_block"]: r["n"] for r in keyed.groupBy("_block").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(counts)
    places = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = communication_matrix([counts[b] for b in order], places, seed)
    bounds = [
        (block, [sum(dealt[: j + 1]) for j in range(shards)]) for block, dealt in zip(order, matrix)
    ]
    table = literal_rows(spark, bounds, {"_block": "int", "_upto": "array<bigint>"})

    ranked = _ranked(keyed, "_block", "_part", "_k1").withColumn("_rank", F.col("_at") + 1)
    dealt = ranked.join(F.broadcast(table), "_block").withColumn(
        "shard", F.size(F.filter("_upto", lambda upto: upto < F.col("_rank")))
    )
    dealt = staged(
        dealt.withColumn("_range", _block(F.col("_k2"), max(1, math.ceil(total / shards / block_rows)))).drop(
            "_upto", "_rank", "_at", "_block", "_part", "_k1"
        ),
        "dealt",
    )

    placed = _ranked(dealt, "shard", "_range", "_k2")
    return placed.select(*KEY, "shard", F.col("_at").cast("bigint").alias("slot"))
