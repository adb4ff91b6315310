"""Exact n-gram Jaccard join by partitioning the universe of shingles.

A document's set holds its distinct three-word shingles. Documents with equal sets form a
class first, and only one document of each class goes on. Sizes are cut into bands.
Two linked sets whose smaller one has s shingles differ in at most H = s/9 of them (for a
similarity of 0.9). A band hashes shingles into segments, so that a set splits into one
subset per segment; a shingle in which two sets differ parts them in one segment. A segment
can also be indexed with its one-deletion neighbourhood: then two sets are parted
there only if they differ twice, so such a segment counts for two, and fewer, longer segments do. Bands
begin without neighbourhoods; what their subsets meet is then counted, by size, and a band in which longer
segments with neighbourhoods cost less is indexed anew with those (see ``costed``). Sets near a band's upper
end are met by larger ones, which index themselves in that band as visitors.

Empty subsets are never indexed, nor what a neighbourhood makes of a single shingle: all
sets of a band would meet in them. What linked sets then have in common follows from either
set alone. If the segments that are filled in it (with two shingles or more, where there is a
neighbourhood) count for more than it may differ in, it shares a subset that is not empty
with whichever set it links with; without neighbourhoods it shares as many as they exceed
that by. A set that has too few filled segments is cut again, by another hash. Take two
linked sets and the first hash by which one of them has enough: both were cut
by it, and they share a subset there. A set that never has enough, which only happens to tiny
ones, is indexed by its single shingles in the end, of which linked sets share one.

Documents with a common subset are candidates. All pairs of a bucket are never listed.
Each member is first verified against the bucket's hub, its best connected set;
verified links give components. Buckets that still hold several components get further
hubs, some rounds long (see ``_to_more_hubs``). Then only pairs of one bucket that lie in different
components are left, and of those the ones that can still link: what each member lacks of
the hub and has besides bounds how far two members differ (see ``_left_to_verify``). What
passes is verified on the whole sets.

Shingles are compared by 64-bit hashes and classes by 128-bit digests of the sorted
hashes. Null or empty text has no shingles and links with nothing; so has a null id. With
fewer words than a shingle the whole sequence is the one shingle. Similarities of two thirds
or less are refused: sets that link would be more than a band apart. Rows repeated under
one id are copies; an id with several texts stands for all of them. An empty table
gives an empty result. Extra columns are ignored by ``link_documents`` and kept by
``keep_one``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsieve.llm import _segments
from rowsieve.llm._graph import components
from rowsieve.llm._shared import (
    ROW_KEY,
    carried,
    discarded,
    importable_by_workers,
    join_by,
    staged,
    text_of,
    uncarried,
)

# Fixed values of the registered query: words of a shingle, and similarity in hundredths.
WORDS = 3
LEAST = 90
BAND_GROWTH = 1.5
#: Segments that a band has beyond the needed, in spreads of the number of empty ones.
SPARE = 2.0
#: Hashes that a set is cut into segments by, while too few are filled; then single shingles.
LEVELS = 8
#: A table of ids is broadcast up to so many rows (some MB), and joined by shuffle beyond.
MOST_BROADCAST = 1_000_000

#: Rounds in which members that are in too few open buckets leave.
PRUNINGS = 3
#: Rounds in which open buckets get further hubs, and how many each.
HUB_ROUNDS, MORE_HUBS = 2, 6

#: What a set that is met costs, in indexed signatures; and the share of its cost that another
#: allocation must stay under, since the index is made anew for it.
CANDIDATE_COST, CHEAPER = 4.0, 0.5
#: Number of shingles from which on subsets count as of one size when costs are counted.
MOST_SIZE = 15
#: How many signatures are marked in a broadcast bitmap at most, 128 MB; and signatures counted at a time.
MOST_MARKED, FLUSH_KEYS = 1 << 26, 2_000_000
#: Bits of the number of common signatures; a set with more counts as with so many.
COMMON_BITS = 16
COMMON = (1 << COMMON_BITS) - 1

_U = np.uint64

#: Segments, and how many of them have neighbourhoods, by the end of a band.
Plan = dict[int, tuple[int, int]]


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the result depends on every bit given."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingler:
    """Sorted distinct shingle hashes of texts; word hashes are kept a while."""

    def __init__(self, words: int = WORDS, most_kept: int = 500_000):
        self.words, self.most, self.kept = words, most_kept, {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.array([], _U)
        kept = self.kept
        if len(kept) > self.most:
            kept.clear()
        row = []
        for word in words:
            code = kept.get(word)
            if code is None:
                code = kept[word] = xxhash.xxh3_64_intdigest(word)
            row.append(code)
        codes = np.array(row, _U)
        n = min(self.words, len(codes))
        out = _mix(codes[: len(codes) - n + 1] + _U(n))
        for k in range(1, n):
            out = _mix(out * _U(3) + codes[k : len(codes) - n + 1 + k])
        return np.unique(out)


@lru_cache
def bands(most: int) -> list[int]:
    """Least sizes of the bands, up to one that begins beyond ``most``."""
    starts = [1]
    while starts[-1] <= most:
        starts.append(max(starts[-1] + 1, int(np.ceil(starts[-1] * BAND_GROWTH))))
    return starts


@lru_cache
def allocation(size: int, least: int = LEAST) -> tuple[int, int]:
    """Segments of a band whose sets have at most ``size`` shingles, before costs are known:
    so many that the largest sets keep a filled one beyond those that linked sets may
    differ in. None has a neighbourhood."""
    differ = _differ(size, least)
    if not differ:
        return 1, 0

    def spare(segments: int) -> float:
        empty = segments * (1 - 1 / segments) ** size
        return segments - differ - empty - SPARE * empty**0.5

    # Of small sets none has so many: then as many as possible.
    enough = (s for s in range(differ + 1, size + 1) if spare(s) >= 1)
    return next(enough, None) or max(range(differ + 1, size + 1), key=spare, default=differ + 1), 0


def _differ(size: int, least: int) -> int:
    """In how many shingles a set of this size and one it links with, if no smaller, differ at most."""
    return size * (100 - least) // least


def _sized(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Codes whose lowest bits hold how many shingles they stand for, so that costs can be counted."""
    return (codes & ~_U(MOST_SIZE)) | np.minimum(sizes, MOST_SIZE).astype(_U)


def costed(met_by_size: dict[tuple[int, int], tuple[int, int]], least: int) -> Plan:
    """Allocations of the bands in which neighbourhoods are cheaper, by what subsets met.

    ``met_by_size`` gives, for each band's end and number of shingles in a subset, how many subsets were indexed
    and how many others, in all, they met. A set of n shingles has n/m in each of m segments, Poisson
    distributed. A segment costs its signatures, and each set that it meets ``CANDIDATE_COST`` of
    them. An allocation with neighbourhoods is taken where it costs less than ``CHEAPER`` of the
    one without.
    """
    plan: Plan = {}
    for end in sorted({end for end, _ in met_by_size}):
        differ, size = _differ(end - 1, least), (end - 1) / BAND_GROWTH**0.5
        rate = {k: met / n for (e, k), (n, met) in met_by_size.items() if e == end and n}
        if not differ or not rate:
            continue

        def meets(k: int) -> float:
            """Of the nearest size that was met."""
            return rate[min(rate, key=lambda have: (abs(have - min(k, MOST_SIZE)), have))]

        def cost(segments: int, widened: int) -> float:
            mean, total, share = size / segments, 0.0, math.exp(-size / segments)
            for k in range(1, int(mean + 8 * mean**0.5) + 8):
                share *= mean / k
                single = 1 + CANDIDATE_COST * meets(k)
                total += share * segments * single
                if k > 1:
                    total += share * widened * k * (1 + CANDIDATE_COST * meets(k - 1))
            return total

        plain = allocation(end - 1, least)
        options = [(differ + 1 - w, w) for w in range(1, (differ + 1) // 2 + 1)]
        if options:
            best = min(options, key=lambda option: cost(*option))
            if cost(*best) < CHEAPER * cost(*plain):
                plan[end] = best
    return plan


def signatures(shingles: np.ndarray, end: int, least: int, differ: int, plan: Plan) -> tuple[np.ndarray, int]:
    """Signatures of a set in the band of sizes below ``end``, and how many of them it has
    in common with any set there that it links with, differing in ``differ`` at most.

    No signature if only equal sets link.
    """
    if not _differ(end - 1, least):
        return np.array([], np.int64), 0
    size, (segments, widened) = len(shingles), plan.get(end) or allocation(end - 1, least)
    cuts = np.array([(k << 64) // segments for k in range(segments)], _U)
    out, common, level = [], 0, 0
    while True:
        # Segments are ranges of the hash, so each subset is a stretch of the sorted set.
        codes = np.sort(_mix(shingles ^ _U(level * 0x9E3779B97F4A7C1))) if level else shingles
        at = np.append(np.searchsorted(codes, cuts), len(codes))
        marks = _mix(codes + _U(0x9E3779B97F4A7C15))
        upto = np.concatenate([np.zeros(1, _U), np.cumsum(marks, dtype=_U)])
        sums, filled = upto[at[1:]] - upto[at[:-1]], np.diff(at)
        salt = _mix(np.arange(segments, dtype=_U) + _U(end) * _U(0x100000001B3) + _U(level << 48))
        out.append(_sized(_mix(sums ^ salt), filled)[filled > 0])
        for k in range(widened):
            if filled[k] > 1:
                fewer = _mix((sums[k] - marks[at[k] : at[k + 1]]) ^ salt[k])
                out.append(_sized(fewer, np.full(filled[k], filled[k] - 1)))
        # What it takes to part this set from another in all segments that count.
        holds = int((filled[widened:] > 0).sum()) + 2 * int((filled[:widened] > 1).sum())
        if not level:
            common = 1 if widened else max(holds - differ, 1)
        level += 1
        if holds <= differ and level == LEVELS:
            out.append(_sized(_mix(shingles ^ _U(end)), np.ones(size, np.int64)))
        elif holds <= differ:
            continue
        return np.unique(np.concatenate(out)).view(np.int64), common


def indexed(
    shingles: np.ndarray, least: int = LEAST, plan: Plan | None = None
) -> tuple[tuple[np.ndarray, int], tuple[np.ndarray, int]]:
    """``signatures`` of a set in its own band, and as a visitor of the band below."""
    size, plan = len(shingles), plan or {}
    none = np.array([], np.int64), 0
    if not size:
        return none, none
    starts = bands(size)
    own = signatures(shingles, starts[-1], least, _differ(size, least), plan)
    lower = starts[-2] if len(starts) > 1 else 1
    # ``lower`` is where the own band begins: sets below it may be linked as the smaller.
    if size * least > 100 * (lower - 1):
        return own, none
    return own, signatures(shingles, lower, least, _differ(lower - 1, least), plan)


INDEX = (
    "doc_id bigint, n_shingles bigint, digest binary, own array<bigint>, own_common int, "
    "visits array<bigint>, visits_common int"
)


def _index_rows(batches: Iterator[pa.RecordBatch], words: int, least: int, plan: Plan) -> Iterator[pa.RecordBatch]:
    shingle = Shingler(words)
    for batch in batches:
        sets = [shingle(t) for t in batch.column("text").to_pylist()]
        both = [indexed(s, least, plan) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                *[
                    column
                    for side in zip(*both)
                    for column in (_lists([sigs for sigs, _ in side]), pa.array([n for _, n in side], pa.int32()))
                ],
            ],
            [c.split()[0] for c in INDEX.split(", ")],
        )


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate([np.array([], np.int64), *[r.view(np.int64) for r in rows]])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))


def _set_rows(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    shingle = Shingler(words)
    for batch in batches:
        sets = _lists([shingle(t) for t in batch.column("text").to_pylist()])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sets], ["id", "shingles"])


def _small(ids: DataFrame) -> DataFrame:
    """A staged table with a broadcast hint while it has few enough rows."""
    return F.broadcast(ids) if ids.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else ids


def _sets_of(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """The sets that are in ``ids(id)``, so that a join shuffles no others."""
    return sets.join(_small(staged(ids.distinct(), "needed")), "id", "left_semi")


def _may_link(a: Column, b: Column, least: int) -> Column:
    return 100 * F.least(a, b) >= least * F.greatest(a, b)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs(a, b)`` with the sizes of both sets and of what they share."""
    left, right = (
        _sets_of(sets, pairs.select(F.col(side).alias("id"))).select(
            F.col("id").alias(side), F.col("shingles").alias(f"_{side}")
        )
        for side in ("a", "b")
    )
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select(
            "a",
            "b",
            F.size("_a").cast("bigint").alias("size_a"),
            F.size("_b").cast("bigint").alias("size_b"),
            F.size(F.array_intersect("_a", "_b")).cast("bigint").alias("shared"),
        )
    )


def _met(texts: DataFrame, words: int, least: int, plan: Plan) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The index, who stands for classes of equal sets, their copies, and members of buckets."""
    index = staged(texts.mapInArrow(lambda b: _index_rows(b, words, least, plan), INDEX), "index")

    # Classes of equal sets, each standing in for its least document.
    with_set = index.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = with_set.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    several = classes.where("copies > 1")
    copies = staged(
        with_set.select("doc_id", "digest").join(several, "digest").select("doc_id", "rep", "copies"), "copies"
    )
    stands_for = copies.select("doc_id", "rep", "copies").distinct()
    marked = _marked(_reps(index, stands_for))
    members = _members(marked)
    buckets = members.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    met = members.join(buckets, "sig").select(
        "sig",
        "id",
        "n",
        F.shiftright("meta", COMMON_BITS + 1).alias("size"),
        F.shiftright("meta", 1).bitwiseAND(F.lit(COMMON)).cast("int").alias("common"),
        (F.col("meta") % 2 == 1).alias("visits"),
    )
    return index, stands_for, copies, staged(met, "met")


def _reps(index: DataFrame, stands_for: DataFrame) -> DataFrame:
    """The sets that stand for a class."""
    with_set = index.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    reps = with_set.join(_small(stands_for), "doc_id", "left").where(
        F.col("rep").isNull() | (F.col("rep") == F.col("doc_id"))
    )
    return reps.select("doc_id", "n_shingles", "own", "own_common", "visits", "visits_common")


def _marked(reps: DataFrame) -> DataFrame:
    """The sets with those signatures only that occur twice, and some more.

    Most signatures occur once. They are counted first, by the bits of a segment of their hash and 32
    more, a few bytes each; those that occur twice mark a bitmap, which is broadcast up to a bounded size. Beyond it all
    signatures stay. False marks cost rows, not results.
    """
    total = reps.agg(F.sum(F.size("own") + F.size("visits"))).first()[0] or 0
    bits = _segments.segment_bits(total)

    def codes(batch: pa.RecordBatch, name: str) -> np.ndarray:
        return batch.column(name).flatten().to_numpy(zero_copy_only=False).view(_U)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held += [codes(batch, "own"), codes(batch, "visits")]
            size += len(held[-1]) + len(held[-2])
            if size >= FLUSH_KEYS:
                yield _segments.blobs(*_segments.summed(np.concatenate(held)), bits, short=True)
                held, size = [], 0
        if size:
            yield _segments.blobs(*_segments.summed(np.concatenate(held)), bits, short=True)

    runs = reps.select("own", "visits").mapInArrow(counted, _segments.BLOBS)
    marks = _segments.marks_of(staged(_segments.met_twice(runs), "met-twice"), bits, MOST_MARKED)
    if marks is None:
        return reps
    shared = reps.sparkSession.sparkContext.broadcast(marks)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            for at in (2, 4):
                lists = batch.column(at)
                own = lists.flatten().to_numpy(zero_copy_only=False)
                there = shared.value.has(own.view(_U))
                ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
                upto = np.concatenate([[0], np.cumsum(there)])[ends].astype(np.int32)
                columns[at] = pa.ListArray.from_arrays(pa.array(upto), pa.array(own[there]))
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return reps.mapInArrow(kept, reps.schema)


def _members(reps: DataFrame) -> DataFrame:
    """One row per signature of the sets; ``meta`` holds the set's size, how many signatures it has
    in common with any that it links with, and in its lowest bit whether it is a visitor."""

    def rows(column: str, visitor: int) -> DataFrame:
        common = F.least(f"{column}_common", F.lit(COMMON))
        meta = F.shiftleft("n_shingles", COMMON_BITS + 1) + F.shiftleft(common, 1) + F.lit(visitor)
        return reps.select(F.explode(column).alias("sig"), F.col("doc_id").alias("id"), meta.alias("meta"))

    return rows("own", 0).unionByName(rows("visits", 1))


def _met_by_size(
    index: DataFrame, stands_for: DataFrame, met: DataFrame, least: int
) -> dict[tuple[int, int], tuple[int, int]]:
    """For each band's end and subset size, the subsets indexed and the others that they met."""
    ends = bands((index.agg(F.max("n_shingles")).first()[0] or 1) + 1)

    def by_size(rows: DataFrame, size: Column, visits: Column, counted: Column) -> DataFrame:
        band = sum((F.when(size >= start, 1).otherwise(0) for start in ends[1:]), F.lit(0))
        return (
            rows.select(
                (band - F.when(visits, 1).otherwise(0)).alias("band"),
                F.col("sig").bitwiseAND(F.lit(MOST_SIZE)).alias("k"),
                counted.alias("counted"),
            )
            .groupBy("band", "k")
            .agg(F.sum("counted").alias("counted"))
        )

    meta = F.col("meta")
    size = F.shiftright(meta, COMMON_BITS + 1)
    every = by_size(_members(_reps(index, stands_for)), size, meta % 2 == 1, F.lit(1)).collect()
    others = by_size(met, F.col("size"), F.col("visits"), F.col("n") - 1).collect()
    met_there = {(r["band"], r["k"]): r["counted"] for r in others}
    return {
        (ends[r["band"] + 1], r["k"]): (r["counted"], met_there.get((r["band"], r["k"]), 0))
        for r in every
        if r["band"] + 1 < len(ends)
    }


def link_documents(docs: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """doc_id, n_shingles and component_id, one row per document."""
    if not 100 / BAND_GROWTH < least <= 100:
        raise ValueError(f"a similarity of {least} in hundredths may link sets that are bands apart")
    spark = docs.sparkSession
    importable_by_workers(spark)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    index, stands_for, copies, met = _met(texts, words, least, {})
    plan = costed(_met_by_size(index, stands_for, met, least), least)
    if plan:
        discarded(index, copies, met)
        index, stands_for, copies, met = _met(texts, words, least, plan)
    known = staged(index.select("doc_id", "n_shingles"), "sizes")
    discarded(index)

    # The hub of a bucket is the member that is in most buckets, no visitor if there is
    # another: copies with few edits share most subsets, so a family agrees on its hub.
    degree = met.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    ranked = met.join(staged(degree, "degrees"), "id")
    first = F.min(F.struct("visits", (-F.col("degree")).alias("rank"), "id", "size", "common")).alias("hub")
    hubs = ranked.groupBy("sig").agg(first).select(
        "sig",
        F.col("hub.id").alias("hub"),
        F.col("hub.size").alias("hub_size"),
        F.col("hub.visits").alias("hub_visits"),
        F.col("hub.common").alias("hub_common"),
    )
    bare, met = met, staged(met.join(hubs, "sig"), "met-hubs")
    discarded(bare)
    # Linked sets have both sets' number of subsets in common. A pair that falls short here has
    # the others, if any, in buckets of other hubs, where the search below considers it.
    both = F.greatest("common", "hub_common")
    to_hub = (
        met.where((F.col("id") != F.col("hub")) & ~(F.col("visits") & F.col("hub_visits")))
        .where(_may_link(F.col("size"), F.col("hub_size"), least))
        .groupBy(F.col("id").alias("a"), F.col("hub").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(both).alias("common"))
        .where("n >= common")
        .select("a", "b")
    )
    to_hub = staged(to_hub, "to-hub")
    candidates = staged(met.select(F.col("id").alias("doc_id")).distinct(), "candidates")
    sets = staged(
        texts.join(_small(candidates), "doc_id", "left_semi").mapInArrow(
            lambda b: _set_rows(b, words), "id bigint, shingles array<bigint>"
        ),
        "sets",
    )
    tested = staged(verified(to_hub, sets), "tested")
    linked = 100 * F.col("shared") >= least * (F.col("size_a") + F.col("size_b") - F.col("shared"))
    links = tested.where(linked).select("a", "b")
    found = staged(components(links), "components")

    left = _open_members(met.select("sig", "id", "n", "size", "visits", "common", "hub"), found, PRUNINGS)
    for turn in range(HUB_ROUNDS):
        pairs = _to_more_hubs(left, turn, least)
        pairs = staged(pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti"), "to-more-hubs")
        more = staged(verified(pairs, sets), "tested")
        new = more.where(linked).select("a", "b")
        if new.isEmpty():
            break
        tested, links = tested.unionByName(more), links.unionByName(new)
        found = staged(components(links), "components")
        before, left = left, _open_members(left.drop("component"), found, 1)
        discarded(before)

    pairs = _left_to_verify(left, tested, sets, least)
    second = staged(verified(pairs, sets).where(linked).select("a", "b"), "second-links")
    discarded(sets, left, met)
    if not second.isEmpty():
        found = staged(components(links.unionByName(second)), "components")

    named = join_by(known, copies.select("doc_id", "rep").distinct(), "left", "doc_id")
    root = F.coalesce("rep", "doc_id")
    named = named.select("doc_id", "n_shingles", root.alias("id"))
    joined = named.join(found.groupBy("id").agg(F.min("component").alias("component")), "id", "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "id").alias("component_id"))


def _open_members(members: DataFrame, found: DataFrame, prunings: int) -> DataFrame:
    """Members of buckets that hold two components, with their components.

    Who is in too few open ones to link leaves, which closes others. All buckets count for
    that, those of two members too: a pair may have part of what it has in common there.
    """
    left = members.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    for _ in range(prunings):
        split = left.groupBy("sig").agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
        in_open = left.join(split.where("c0 <> c1").select("sig"), "sig", "left_semi")
        before, in_open = left, staged(in_open, "open")
        discarded(before)
        enough = (
            in_open.groupBy("id", "visits")
            .agg(F.count(F.lit(1)).alias("n"), F.first("common").alias("common"))
            .where("n >= common")
            .select("id", "visits")
        )
        left = staged(in_open.join(enough, ["id", "visits"], "left_semi"), "left")
        discarded(in_open)
    return left


def _to_more_hubs(left: DataFrame, turn: int, least: int) -> DataFrame:
    """Pairs of members and a few further hubs of their buckets, in other components.

    A family whose members are near one another but not near its first hub would leave all its pairs
    to verify; a few of its own members as hubs, the same ones in all its buckets, bring most of
    it together, at a cost in proportion to the members.
    """
    first = Window.partitionBy("sig").orderBy("visits", F.xxhash64("id", F.lit(turn)), "id")
    several = left.where("n > 2")
    hubs = several.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= MORE_HUBS)
    hubs = hubs.select(
        "sig", *[F.col(c).alias(f"hub_{c}") for c in ("id", "size", "visits", "common", "component")]
    )
    met = several.join(hubs, "sig").where(
        (F.col("component") != F.col("hub_component"))
        & ~(F.col("visits") & F.col("hub_visits"))
        & _may_link(F.col("size"), F.col("hub_size"), least)
    )
    return (
        met.groupBy(F.least("id", "hub_id").alias("a"), F.greatest("id", "hub_id").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.greatest("common", "hub_common")).alias("common"))
        .where("n >= common")
        .select("a", "b")
    )


def _left_to_verify(left: DataFrame, tested: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Pairs of one bucket in different components that the bounds do not rule out.

    A member x of a bucket has extra shingles, which the hub lacks, and lacks some of the
    hub's. Two members differ by what they lack one without the other and by their extra
    ones, less twice those they share. So pairs are close enough without a shared extra
    shingle (rare: both are close to the hub, and then mostly linked to it), or must
    share some. Those meet on the rarest extra shingle that they share: of E extra ones it is
    among the rarest T + 1, where T is the most they may differ, and no more are shared
    than are at least as frequent.
    """
    # In a bucket of two, one is the hub. A pair that meets enough under one of its own was
    # tested there; any other also meets under a third hub.
    left = left.where("n > 2 and id <> hub").drop("n")

    around = left.select("id", "hub", "size", "component").distinct()
    around = staged(around, "members")
    own = _sets_of(sets, around.select("id")).select("id", F.col("shingles").alias("_own"))
    hubs = _sets_of(sets, around.select(F.col("hub").alias("id")))
    hubs = hubs.select(F.col("id").alias("hub"), F.col("shingles").alias("_hub"))
    around = staged(
        around.join(own, "id")
        .join(hubs, "hub")
        .select(
            "id",
            "hub",
            "size",
            "component",
            F.array_except("_own", "_hub").alias("extra"),
            F.size(F.array_except("_hub", "_own")).alias("lacks"),
        )
        .withColumn("extras", F.size("extra")),
        "around",
    )
    allowed = F.floor((F.col("a.size") + F.col("b.size")) * (100 - least) / (100 + least))
    lacking = F.abs(F.col("a.lacks") - F.col("b.lacks"))
    apart = (
        (F.col("a.id") < F.col("b.id"))
        & (F.col("a.component") != F.col("b.component"))
        & _may_link(F.col("a.size"), F.col("b.size"), least)
    )

    def pair(rows: DataFrame, on: Column) -> DataFrame:
        met_there = rows.alias("a").join(rows.alias("b"), on & apart)
        return met_there.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))

    beside = left.join(around.select("id", "hub", "lacks", "extras"), ["id", "hub"])
    close = pair(
        staged(beside, "beside"),
        (F.col("a.sig") == F.col("b.sig"))
        & ~(F.col("a.visits") & F.col("b.visits"))
        & (F.col("a.extras") + F.col("b.extras") + lacking <= allowed),
    )

    # Rows are kept narrow: a shingle beside a hub is one hash, and so is a member beside it.
    # Where hashes meet by chance, more pairs are considered, never fewer.
    extra = around.select(F.xxhash64("id", "hub").alias("r"), "hub", F.explode("extra").alias("s"))
    extra = extra.select("r", F.xxhash64("hub", "s").alias("s"))
    common = extra.groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    differ = F.floor(F.col("size") * (100 - least) / least)
    rare_first = Window.partitionBy("r").orderBy(F.col("n").desc(), "s")
    # Ranked from the most frequent: shingles that occur once need not be ranked at all.
    ranked = extra.join(common, "s").withColumn("rank", F.row_number().over(rare_first))
    ranked = ranked.join(around.drop("extra").withColumn("r", F.xxhash64("id", "hub")), "r")
    most_allowed = F.floor((F.col("size") + F.col("most_size")) * (100 - least) / (100 + least))
    shared = F.ceil((F.col("extras") + F.col("least_extras") - most_allowed) / 2)
    needed = F.greatest(F.col("extras") - differ, shared, F.lit(1))
    beside_hub = around.groupBy("hub").agg(F.min("extras").alias("least_extras"), F.max("size").alias("most_size"))
    ranked = ranked.join(staged(beside_hub, "beside-hubs"), "hub")
    prefix = ranked.where(F.col("rank") >= needed).drop("n", "least_extras", "most_size")
    prefix = staged(prefix, "prefixes")
    sharing = pair(
        prefix,
        (F.col("a.s") == F.col("b.s"))
        & (F.col("a.hub") == F.col("b.hub"))
        & (F.col("a.extras") + F.col("b.extras") + lacking - allowed <= 2 * F.least("a.rank", "b.rank")),
    )
    pairs = close.unionByName(sharing).distinct()
    done = tested.select("a", "b").unionByName(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return staged(pairs.join(done, ["a", "b"], "left_anti"), "left-pairs")


def keep_one(docs: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """One document of each group, that with the least id; others as they were.

    Every row is a document of its own. Rows whose id is null or repeated come after all others and,
    among themselves, in the order of a hash; of those equal in id and text one stays. Documents without shingles
    are groups of their own, equal or not.
    """
    rows = carried(docs).withColumn("node", F.col("doc_id").cast("bigint"))
    counts = staged(rows.groupBy(*ROW_KEY).agg(F.count(F.lit(1)).alias("n")), "rows")
    # Ids that do not name one row; their rows get numbers beyond any id met.
    often = counts.groupBy("doc_id").agg(F.sum("n").alias("n")).where("n > 1 or doc_id is null").select("doc_id")
    odd = staged(join_by(counts.select(*ROW_KEY), often, "left_semi", "doc_id"), "odd-rows")
    some_odd = not odd.isEmpty()
    if some_odd:
        number = F.xxhash64(*ROW_KEY, F.lit("row")).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
        rows = join_by(rows, odd.withColumn("odd", number), "left", *ROW_KEY)
        rows = staged(rows.withColumn("node", F.coalesce("odd", "node")), "numbered")
    groups = link_documents(rows.select(F.col("node").alias("doc_id"), "text"), words, least)
    apart = groups.where((F.col("component_id") != F.col("doc_id")) & (F.col("n_shingles") > 0))
    kept = join_by(rows, apart.select(F.col("doc_id").alias("node")).distinct(), "left_anti", "node")
    if some_odd:
        blank = groups.where("n_shingles = 0").select(F.col("doc_id").alias("node")).distinct()
        several = kept.where(F.col("odd").isNotNull())
        one = join_by(several, blank, "left_anti", "node").dropDuplicates(["node"])
        kept = kept.where(F.col("odd").isNull()).unionByName(one).unionByName(join_by(several, blank, "left_semi", "node"))
    return uncarried(kept, docs)
