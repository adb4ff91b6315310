"""Removal of repeated byte strings by prefix-free parsing.

A rolling hash over 12 bytes triggers phrases: a place is a trigger if its hash is the
least, the last of equals, among the places of some 100-byte window. So every window
has its trigger, equal windows have it at the same place, and a phrase, all windows
that share a trigger with the bytes they span, is set by content alone. The distinct
phrases are the dictionary, and the corpus is parsed into their occurrences.

A phrase that occurred earlier repeats it window by window, so all bytes of later
occurrences go. What is left are windows shared by different phrases of the dictionary,
at the edges of copies. Those agree in 50 bytes before or after the trigger at least, so
only phrases that share such a stretch with another are suspicious; their suffixes of
100 bytes or more are brought together by their first 100 bytes, and all but the earliest in
corpus order go.

What a full suffix array of dictionary and parse would give, the order of all suffixes, is not
needed here and not made: a window lies in one phrase whole, so only equality of the
first 100 bytes of dictionary suffixes matters, and the parse matters for the first occurrence of each
phrase. Equality stands in for order: phrases and suffixes are grouped by 128-bit hashes, each
segment of their range in one task, and of equal ones the least place is found.

To see which phrases can meet at all, stretches are counted first, by the bits of a segment
of their hash and 32 more. Those that occur twice mark a bitmap, sized by their number,
which is broadcast; a phrase whose stretches are not marked occurs once and is never
shuffled, and false marks cost rows, not results. Where there are too many to broadcast, the
phrases are joined with them instead.

Documents come in order of their ids, null first; texts under one id are documents of their own, in
the order of a hash. Of rows equal in id and text one comes first and the others repeat it: all
their bytes go if they have 100 or more. Null or empty text has no bytes. Texts
shorter than 100 bytes are kept whole. An empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm import _segments
from rowsieve.llm._shared import discarded, importable_by_workers, shuffle_parts, staged, text_of

LENGTH = 100
GRAM = 12
REACH = 50
#: How many stretches are marked in a broadcast bitmap at most: 128 MB. More are joined by shuffle.
MOST_MARKED = 1 << 26
FLUSH_KEYS = 2_000_000
#: Ids are broadcast up to so many rows, and joined by shuffle beyond.
MOST_BROADCAST = 1_000_000
NO_ID = -(2**63)
#: Bytes of text that have a stretch to be counted, on average.
BYTES_PER_STRETCH = 24

_U = np.uint64
_PLACE_BITS = _U(28)
_PLACES = _U((1 << 28) - 1)
_BYTES = np.random.default_rng(17).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)


def _triggers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Triggers of a text of 100 bytes or more, and the first and last window of each."""
    h1 = _BYTES[data]
    h2 = h1[:-1] * _U(0x9E3779B97F4A7C15) + h1[1:]
    h4 = h2[:-2] * _U(0xBF58476D1CE4E5B9) + h2[2:]
    h8 = h4[:-4] * _U(0x94D049BB133111EB) + h4[4:]
    rolled = h8[: len(data) - GRAM + 1] * _U(0xD6E8FEB86659FD93) + h4[8 : len(data) - GRAM + 9]
    rolled ^= rolled >> _U(32)
    rolled *= _U(0xD6E8FEB86659FD93)
    # The place counts down in the low bits: of equal hashes the last is least.
    place = _PLACES - (np.arange(len(rolled), dtype=np.uint64) & _PLACES)
    key = (rolled & ~_PLACES) | place
    width, have = LENGTH - GRAM + 1, 1
    least = key
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    rest = width - have
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    at = (_PLACES - (least & _PLACES)).astype(np.int64)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    last = np.append(first[1:], len(at)) - 1
    return at[first], first, last


def _phrases(raw: bytes) -> list[tuple[int, int, int, int | None, int | None]]:
    """(trigger, first window, last window, hash before, hash after) of each phrase."""
    if len(raw) < LENGTH:
        return []
    digest, out = xxhash.xxh3_64_intdigest, []
    for at, first, last in zip(*(x.tolist() for x in _triggers(np.frombuffer(raw, np.uint8)))):
        before = digest(raw[at - REACH : at + GRAM], seed=1) if at - first >= REACH else None
        after = digest(raw[at : at + REACH], seed=2) if at - last < REACH else None
        out.append((at, first, last, before, after))
    return out


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _stretches(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    keys = array("Q")
    for batch in batches:
        for text in batch.column("text").to_pylist():
            for _, _, _, before, after in _phrases(_bytes(text)):
                if before is not None:
                    keys.append(before)
                if after is not None:
                    keys.append(after)
            if len(keys) >= FLUSH_KEYS:
                yield _segments.blobs(*_segments.summed(np.array(keys)), bits, short=True)
                keys = array("Q")
    if keys:
        yield _segments.blobs(*_segments.summed(np.array(keys)), bits, short=True)


PHRASES = (
    "id bigint, tie bigint, before bigint, after bigint, phrase bigint, check bigint, first int, last int, at int"
)


def _signed(key: int | None) -> int | None:
    return None if key is None else key - (1 << 64) if key >> 63 else key


def _meeting(batches: Iterator[pa.RecordBatch], marks) -> Iterator[pa.RecordBatch]:
    """Phrases with a marked stretch, or all of them without marks."""
    marks = marks and marks.value
    names = [c.split()[0] for c in PHRASES.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.int32()] * 3

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        rows = []
        for key, tie, text in zip(*(batch.column(c).to_pylist() for c in ("id", "tie", "text"))):
            raw = _bytes(text)
            for at, first, last, before, after in _phrases(raw):
                if marks is None or before in marks or after in marks:
                    phrase = xxhash.xxh3_128_intdigest(raw[first : last + LENGTH])
                    high, low = _signed(phrase >> 64), _signed(phrase & (1 << 64) - 1)
                    rows.append((key, tie, _signed(before), _signed(after), high, low, first, last, at))
            if len(rows) >= 20_000:
                yield out(rows)
                rows = []
        if rows:
            yield out(rows)


def _shared_phrases(texts: DataFrame) -> DataFrame:
    """Occurrences of phrases that have a stretch in common with another, and some more."""
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = _segments.segment_bits(size // BYTES_PER_STRETCH)
    stretches = texts.select("text").mapInArrow(lambda b: _stretches(b, bits), _segments.BLOBS)
    twice = staged(_segments.met_twice(stretches), "stretches")
    marks = _segments.marks_of(twice, bits, MOST_MARKED)
    if marks:
        shared = spark.sparkContext.broadcast(marks)
        return texts.mapInArrow(lambda b: _meeting(b, shared), PHRASES)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                whole = np.frombuffer(found, np.uint32).astype(np.int64) | (segment << 32)
                yield pa.RecordBatch.from_arrays([pa.array(whole)], ["key"])

    marked = twice.select("segment", "keys").mapInArrow(keys, "key bigint")
    every = staged(texts.mapInArrow(lambda b: _meeting(b, None), PHRASES), "all-phrases")
    sides = [
        every.where(F.col(side).isNotNull())
        .withColumn("key", F.shiftrightunsigned(side, 32 - bits))
        .join(marked, "key", "left_semi")
        .drop("key")
        for side in ("before", "after")
    ]
    # A phrase with both sides marked is one; equal rows' phrases are the same, too.
    return sides[0].unionByName(sides[1]).dropDuplicates(["id", "tie", "first"])


SUFFIXES = "segment int, hashes binary, checks binary, ids binary, ties binary, starts binary"
#: What a run of suffixes holds of each, in the order of the columns.
_KINDS = (_U, _U, np.int64, np.int64, np.int32)


def _suffixes(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Suffixes that phrases may share: hashes of their first bytes, and their places.

    They leave in runs sorted by hash, one row per segment of the hash's range.
    """
    digest = xxhash.xxh3_128_digest
    hashes, owners, starts = bytearray(), [], array("i")

    def out() -> pa.RecordBatch:
        both = np.frombuffer(bytes(hashes), _U).reshape(-1, 2)
        order = np.argsort(both[:, 0], kind="stable")
        sizes = [o[2] for o in owners]
        ids, ties = (np.repeat(np.array([o[k] for o in owners], np.int64), sizes) for k in (0, 1))
        columns = [x[order] for x in (both[:, 0], both[:, 1], ids, ties, np.array(starts, np.int32))]
        at = np.searchsorted(columns[0], np.arange(1 << bits, dtype=_U) << _U(64 - bits))
        at = np.append(at, len(order))
        full = np.flatnonzero(np.diff(at))
        parts = [[x[at[s] : at[s + 1]].tobytes() for s in full] for x in columns]
        return pa.RecordBatch.from_arrays(
            [pa.array(full.astype(np.int32)), *[pa.array(x, pa.binary()) for x in parts]],
            [c.split()[0] for c in SUFFIXES.split(", ")],
        )

    for batch in batches:
        for key, tie, text, ranges in zip(*(batch.column(c).to_pylist() for c in ("id", "tie", "text", "ranges"))):
            raw, before = _bytes(text), len(starts)
            for r in ranges:
                for at in range(r["start"], r["end"]):
                    hashes += digest(raw[at : at + LENGTH])
                    starts.append(at)
            owners.append((key, tie, len(starts) - before))
            if len(starts) >= FLUSH_KEYS // 4:
                yield out()
                hashes, owners, starts = bytearray(), [], array("i")
    if starts:
        yield out()


def _later_equals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of suffixes, in order of hash and place, that equal the one before."""
    at, parts = None, []

    def done() -> pa.RecordBatch:
        columns = [np.concatenate([p[i] for p in parts]) for i in range(5)]
        order = np.lexsort(columns[::-1])
        hashes, checks, ids, ties, starts = (x[order] for x in columns)
        again = np.append(False, (hashes[1:] == hashes[:-1]) & (checks[1:] == checks[:-1]))
        # A suffix at the same place as the earliest is that suffix, of an equal row.
        first = np.maximum.accumulate(np.where(again, 0, np.arange(len(hashes))))
        again &= (ids != ids[first]) | (ties != ties[first]) | (starts != starts[first])
        found = [pa.array(x[again]) for x in (ids, ties, starts)]
        return pa.RecordBatch.from_arrays(
            [*found, pa.array(starts[again] + np.int32(LENGTH))], ["id", "tie", "start", "end"]
        )

    for batch in batches:
        for segment, *runs in zip(*(c.to_pylist() for c in batch.columns)):
            if segment != at and at is not None:
                yield done()
                parts = []
            at = segment
            parts.append([np.frombuffer(x, kind) for x, kind in zip(runs, _KINDS)])
    if at is not None:
        yield done()


RESULT = "id bigint, tie bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"


def _cut(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[pa.RecordBatch]:
    """Texts without their runs; runs may overlap and come in any order."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    for batch in batches:
        rows = []
        for key, tie, text, runs in zip(*(batch.column(c).to_pylist() for c in ("id", "tie", "text", "runs"))):
            raw, kept, at, spans = _bytes(text), [], 0, 0
            upto = -1
            for start, end in sorted((r["start"], r["end"]) for r in runs or ()):
                if start > upto:  # runs that touch are one
                    kept.append(raw[at:start])
                    spans += 1
                upto = at = max(upto, end)
            left = b"".join([*kept, raw[at:]])
            rows.append(
                (
                    key,
                    tie,
                    len(raw),
                    len(raw) - len(left),
                    spans,
                    hashlib.sha256(left).hexdigest(),
                    left.decode("utf-8", "replace") if keep_text else None,
                )
            )
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds)], names)


ROW = ["id", "tie"]


def repeated_runs(texts: DataFrame) -> DataFrame:
    """(id, tie, start, end) of bytes to remove from ``texts(id, tie, text)``; runs may overlap.

    Rows equal in id and tie count as one."""
    spark = texts.sparkSession
    phrases = staged(_shared_phrases(texts), "phrases")

    # The dictionary: each phrase with its earliest occurrence.
    name, place = ["phrase", "check"], F.struct("id", "tie", "first")
    entries = phrases.groupBy(*name).agg(
        F.min(F.struct("id", "tie", "first", "last", "at", "before", "after")).alias("e"), F.count(F.lit(1)).alias("n")
    )
    entries = staged(entries.select(*name, "n", "e.*"), "dictionary")
    again = entries.where("n > 1").select(*name, place.alias("_place"))
    later = (
        phrases.select(*name, "id", "tie", "first", "last")
        .join(again, name)
        .where(place != F.col("_place"))
        .select(*ROW, F.col("first").alias("start"), (F.col("last") + LENGTH).alias("end"))
    )
    later = staged(later, "later-phrases")
    discarded(phrases)

    # Windows that begin REACH bytes or more before the trigger hold the stretch before it,
    # the others the one after it: only those of a stretch that others share are looked at.
    reach = F.col("at") - REACH
    sides = {
        "before": (F.col("first"), F.least(F.col("last"), reach) + 1),
        "after": (F.greatest(F.col("first"), reach + 1), F.col("last") + 1),
    }
    ranges = [
        entries.where(F.col(side).isNotNull()).select(
            F.xxhash64(F.lit(side), F.col(side)).alias("key"), *ROW, start.alias("start"), end.alias("end")
        )
        for side, (start, end) in sides.items()
    ]
    both = ranges[0].unionByName(ranges[1])
    meeting = both.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    suspicious = both.join(meeting, "key").groupBy(*ROW).agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    suspicious = staged(suspicious, "suspicious")
    windows = suspicious.agg(F.sum(F.aggregate("ranges", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"])))
    bits = _segments.segment_bits(windows.first()[0] or 0)
    runs = _with_texts(texts, suspicious)[0].mapInArrow(lambda b: _suffixes(b, bits), SUFFIXES)
    dealt = runs.repartition(max(shuffle_parts(spark), 12), "segment").sortWithinPartitions("segment")
    return later.unionByName(dealt.mapInArrow(_later_equals, "id bigint, tie bigint, start int, end int"))


def _with_texts(texts: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts joined with what was found for their rows, and the texts without.

    Only texts for which something was found are shuffled, while the rows are few enough
    to be broadcast.
    """
    rows = found.select(*ROW)
    if rows.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST:
        rows = F.broadcast(rows)
    return texts.join(rows, ROW, "left_semi").join(found, ROW), texts.join(rows, ROW, "left_anti")


def _with_copies(result: DataFrame, texts: DataFrame) -> DataFrame:
    """Results in which rows equal in id and text are told apart: one is the first.

    Equal rows are counted for each task, so that none has more of them to write than one read.
    """
    here = texts.groupBy(*ROW, F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
    here = staged(here, "rows")
    equal = here.groupBy(*ROW).agg(F.sum("n").alias("total"), F.min("task").alias("first_task")).where("total > 1")
    equal = staged(equal.drop("total"), "equal-rows")
    if equal.isEmpty():
        return result
    result = staged(result, "cut")
    first = result.join(equal.select(*ROW), ROW, "left_semi").dropDuplicates(ROW)
    more = F.col("n") - F.when(F.col("task") == F.col("first_task"), 1).otherwise(0)
    copies = here.join(equal, ROW).withColumn("more", more.cast("int")).where("more > 0").drop("n")
    long = F.col("n_bytes") >= LENGTH
    copies = (
        copies.join(first, ROW)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("more"))))
        .select(
            *ROW,
            "n_bytes",
            F.when(long, F.col("n_bytes")).otherwise(0).cast("bigint").alias("n_removed"),
            F.when(long, 1).otherwise(0).cast("bigint").alias("n_spans"),
            F.when(long, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
            F.when(long & F.col("kept").isNotNull(), "").otherwise(F.col("kept")).alias("kept"),
        )
    )
    return result.join(equal.select(*ROW), ROW, "left_anti").unionByName(first).unionByName(copies)


def remove_repeats(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 per document; the text left if asked."""
    importable_by_workers(docs.sparkSession)
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID).cast("bigint"))
    texts = docs.select(key.alias("id"), F.xxhash64(text_of()).alias("tie"), text_of().alias("text"))
    # Equal rows find the same runs: a set keeps each once.
    per_row = repeated_runs(texts).groupBy(*ROW).agg(F.collect_set(F.struct("start", "end")).alias("runs"))
    per_row = staged(per_row, "runs-by-row")
    cut, whole = _with_texts(texts, per_row)
    none = F.lit(None).cast(per_row.schema["runs"].dataType)
    whole = whole.withColumn("runs", none)
    result = cut.mapInArrow(lambda b: _cut(b, keep_text), RESULT).unionByName(
        whole.mapInArrow(lambda b: _cut(b, keep_text), RESULT)
    )
    doc_id = F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id")
    columns = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_text else [])]
    return _with_copies(result, texts.select(*ROW)).select(doc_id, *columns)
