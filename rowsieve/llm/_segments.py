"""Counting 64-bit keys in segments of their range.

Tasks send sorted runs of keys, one binary row per segment, so that what is shuffled is
the keys themselves and each key costs a task one entry however often it occurs there. A
segment's runs are merged in one task; segments are ranges of the hash, hence of about
the same size, and their number grows with the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm._shared import shuffle_parts

LEAST_SEGMENTS = 1024
#: Keys, as far as their number is known beforehand, that one more segment is opened for.
KEYS_PER_SEGMENT = 1 << 20
#: Bits of a bitmap for each key marked in it.
MARK_BITS = 16
BLOBS = "segment int, keys binary, counts binary"


def segment_bits(keys: int) -> int:
    """log2 of the number of segments for so many keys."""
    return max(LEAST_SEGMENTS, keys // KEYS_PER_SEGMENT).bit_length() - 1


def blobs(keys: np.ndarray, counts: np.ndarray, bits: int, short: bool = False) -> pa.RecordBatch:
    """Sorted distinct keys and their counts as one row per segment.

    ``short`` keeps the 32 bits that follow the segment's: half the bytes, and some keys
    become equal by chance.
    """
    segments = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    at = np.append(np.searchsorted(keys, segments), len(keys))
    full = np.flatnonzero(np.diff(at))
    if short:
        keys = ((keys << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(full.astype(np.int32)),
            pa.array([keys[at[s] : at[s + 1]].tobytes() for s in full], pa.binary()),
            pa.array([counts[at[s] : at[s + 1]].astype(np.uint32).tobytes() for s in full], pa.binary()),
        ],
        ["segment", "keys", "counts"],
    )


def packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, bytes of one rank together: of small ones most bytes are zero and pack well."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def packed_sorted(numbers: np.ndarray) -> bytes:
    """Sorted 32-bit numbers, by what each has beyond the one before."""
    return packed(np.diff(numbers, prepend=numbers.dtype.type(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint32)


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.array([], int)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def per_segment(
    runs: DataFrame,
    reduce: Callable[[int, np.ndarray, np.ndarray], pa.RecordBatch],
    schema: str,
    short: bool = False,
) -> DataFrame:
    """``reduce(segment, keys, counts)`` of each segment, with its keys merged and counted."""
    kind = np.uint32 if short else np.uint64

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, keys, counts = None, [], []

        def done() -> pa.RecordBatch:
            return reduce(at, *summed(np.concatenate(keys), np.concatenate(counts).astype(np.int64)))

        for batch in batches:
            for segment, k, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if segment != at and at is not None:
                    yield done()
                    keys, counts = [], []
                at = segment
                keys.append(np.frombuffer(k, kind))
                counts.append(np.frombuffer(c, np.uint32))
        if at is not None:
            yield done()

    parts = max(shuffle_parts(runs.sparkSession), 12)
    dealt = runs.repartition(parts, "segment").sortWithinPartitions("segment")
    return dealt.mapInArrow(merged, schema)


def met_twice(runs: DataFrame) -> DataFrame:
    """(segment, n, keys) of the short keys that occur twice or more in ``runs``."""
    return per_segment(runs, _twice, "segment int, n bigint, keys binary", short=True)


def _twice(segment: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """The segment's keys that occur twice or more."""
    twice = keys[counts > 1]
    return pa.RecordBatch.from_arrays(
        [pa.array([segment], pa.int32()), pa.array([len(twice)], pa.int64()), pa.array([twice.tobytes()], pa.binary())],
        ["segment", "n", "keys"],
    )


class Marks:
    """A bitmap of keys, by as many of their highest bits as their number calls for."""

    def __init__(self, n: int, bits: int):
        self.bits = min(max((n * MARK_BITS).bit_length(), 16), bits + 32)
        self.segment_bits = bits
        self.map = np.zeros(1 << (self.bits - 3), np.uint8)

    def mark(self, segment: int, keys: np.ndarray) -> None:
        bit = (np.uint64(segment) << np.uint64(32) | keys.astype(np.uint64)) >> np.uint64(self.segment_bits + 32 - self.bits)
        np.bitwise_or.at(self.map, (bit >> np.uint64(3)).astype(np.int64), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))

    def __contains__(self, key: int | None) -> bool:
        if key is None:
            return False
        bit = key >> (64 - self.bits)
        return bool(self.map[bit >> 3] >> (bit & 7) & 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Which keys are marked."""
        bit = keys >> np.uint64(64 - self.bits)
        return (self.map[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def marks_of(twice: DataFrame, bits: int, most: int) -> Marks | None:
    """A bitmap of the keys of ``met_twice``, or none if they are more than ``most``."""
    n = twice.agg(F.sum("n")).first()[0] or 0
    if n > most:
        return None
    marks = Marks(n, bits)
    for row in twice.toLocalIterator():
        marks.mark(row["segment"], np.frombuffer(row["keys"], np.uint32))
    return marks
