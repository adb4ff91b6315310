"""Whitening of integer vectors: leading components by contour integration, exact moments.

A row is kept if its vector is not null and holds no null, NaN or infinite entry; an entry c
becomes floor(64 c) + 1000000. Two passes gather exact integer moments: the sums S of each
dimension, then, of the vectors less the rounded means, the sums of all products. Tasks add
up their own rows, so one row per task and pair of dimensions is shuffled, and the
covariance V (divisor n) is rounded once, from whole numbers. The driver sees V, which is
dimensions squared numbers whatever the rows; ``feast`` finds its leading eigenpairs and
counts that none is missed. A third pass gathers the whitened vectors' own covariance,
and the result projects every vector once more.

Components are those with positive eigenvalues, most first; eigenvalues that are zero but
for rounding have none, as whitening would divide by zero. So equal rows, a single row or
an empty table give no rows. If vectors have different lengths, the commonest length (of
several, the longest) makes the table and other rows are left out. Entries may be up to 2^27 / 64
in magnitude, else sums could leave 64 bits: larger ones end the job with an error. Equal
eigenvalues may have any unit vectors that span their space. Rows that repeat an id, and rows
without one, are vectors each. Columns other than ``vec_id`` and ``embedding`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm import feast
from rowsieve.llm._shared import importable_by_workers, staged

COMPONENTS = 32
SCALE = 64
OFFSET = 1_000_000
LARGEST = 1 << 27
#: Rows multiplied at a time.
BLOCK = 4096

EXACT = pa.decimal128(38, 0)


def _whole(column: pa.Array, dimensions: int) -> np.ndarray:
    """The integer vectors of a batch."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.floor(values * SCALE)
    if np.abs(x).max(initial=0) > LARGEST:
        raise ValueError(f"an entry times {SCALE} is beyond {LARGEST}: sums could leave 64 bits")
    return x.astype(np.int64).reshape(-1, dimensions) + OFFSET


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], EXACT)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(length, place, n, s) of this task's vectors."""
    total: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
        for length in np.unique(sizes):
            rows = batch.column(1).filter(pa.array(sizes == length))
            x = _whole(rows, int(length)) if length else np.zeros((len(rows), 0), np.int64)
            n, s = total.get(length, (0, np.zeros(length, object)))
            total[length] = n + len(x), s + x.sum(axis=0).astype(object)
    for length, (n, s) in total.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([length] * len(s), pa.int32()),
                pa.array(range(len(s)), pa.int32()),
                pa.array([n] * len(s), pa.int64()),
                _decimals(s),
            ],
            ["length", "place", "n", "s"],
        )


def gram(y: np.ndarray) -> np.ndarray:
    """Exact sums of products of the columns of ``y``, as Python integers."""
    total = np.zeros((y.shape[1], y.shape[1]), object)
    most = int(np.abs(y).max(initial=1)) ** 2
    # Floating products are exact while their sums stay below 2^53.
    step = max(min((1 << 53) // max(most, 1), BLOCK), 1)
    exact = most < 1 << 53
    for at in range(0, len(y), step if exact else 64):
        part = y[at : at + (step if exact else 64)]
        part = part.astype(np.float64) if exact else part
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _products(batches: Iterator[pa.RecordBatch], centre: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(i, j, s): this task's sums of products, j from i on."""
    size = len(centre)
    total = np.zeros((size, size), object)
    for batch in batches:
        total += gram(_whole(batch.column(1), size) - centre)
    if total.any():
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), _decimals(total[i, j])], ["i", "j", "s"]
        )


class Whitener:
    """Projects vectors on scaled components; a few numbers per dimension and component."""

    def __init__(self, n: int, sums: list[int], centre: np.ndarray, values: np.ndarray, vectors: np.ndarray):
        self.n, self.centre = n, centre
        #: What is left of each sum when every vector is taken less the centre.
        self.left = [s - n * c for s, c in zip(sums, centre.tolist())]
        self.mean = np.array([t / n for t in self.left])
        self.scaled = vectors / np.sqrt(values)

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre - self.mean) @ self.scaled

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact."""
        y = x - self.centre
        squares = (y * y).sum(axis=1).tolist()
        most = int(np.abs(y).max(initial=0)) * sum(map(abs, self.left))
        mixed = y @ np.array(self.left, np.int64 if most < 1 << 63 else object)
        rest = sum(t * t for t in self.left)
        n = self.n
        return [n * n * a - 2 * n * int(b) + rest for a, b in zip(squares, mixed.tolist())]


def _spread(batches: Iterator[pa.RecordBatch], whitener: Whitener) -> Iterator[pa.RecordBatch]:
    """(i, j, s): sums of products of this task's whitened vectors; j of -1 for plain sums."""
    size, k = whitener.scaled.shape
    products, plain, n = np.zeros((k, k)), np.zeros(k), 0
    for batch in batches:
        w = whitener.project(_whole(batch.column(1), size))
        products, plain, n = products + w.T @ w, plain + w.sum(axis=0), n + len(w)
    if n:
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([i, np.arange(k)]).astype(np.int32)),
                pa.array(np.concatenate([j, np.full(k, -1)]).astype(np.int32)),
                pa.array(np.concatenate([products[i, j], plain])),
            ],
            ["i", "j", "s"],
        )


def _whitened(batches: Iterator[pa.RecordBatch], whitener: Whitener) -> Iterator[pa.RecordBatch]:
    size = len(whitener.centre)
    for batch in batches:
        x = _whole(batch.column(1), size)
        w = whitener.project(x)
        ends = np.arange(len(x) + 1, dtype=np.int32) * w.shape[1]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                _decimals(whitener.deviation(x)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel())),
            ],
            ["vec_id", "deviation", "whitened"],
        )


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that are kept."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    return kept.where(F.col("embedding").isNotNull() & finite)


def _fit(kept: DataFrame, components: int) -> tuple[Whitener | None, list[float]]:
    """The whitener of a table and each component's share of all variance."""
    exact = "length int, place int, n bigint, s decimal(38,0)"
    sums = staged(kept.mapInArrow(_sums, exact), "sums")
    sums = sums.groupBy("length", "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    sums = staged(sums, "sums-by-length")
    best = sums.where("place = 0").orderBy(F.desc("n"), F.desc("length")).first()
    if best is None:
        return None, []
    n, size = best["n"], best["length"]
    rows = sums.where(F.col("length") == size).orderBy("place").collect()
    total = [int(r["s"]) for r in rows]
    centre = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)
    left = [s - n * c for s, c in zip(total, centre.tolist())]
    same = kept.where(F.size("embedding") == size)
    parts = same.mapInArrow(lambda b: _products(b, centre), "i int, j int, s decimal(38,0)")
    products = parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    covariance = np.zeros((size, size))
    for r in products:
        i, j = r["i"], r["j"]
        covariance[i, j] = covariance[j, i] = (n * int(r["s"]) - left[i] * left[j]) / (n * n)
    values, vectors = feast.leading(covariance, components)
    if not len(values):
        return None, []
    return Whitener(n, total, centre, values, vectors), (values / np.trace(covariance)).tolist()


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error, one row per
    kept vector and component. ``deviation`` is a decimal: beyond some 10^8 vectors it needs more than 64 bits."""
    spark = vectors.sparkSession
    importable_by_workers(spark)
    kept = usable(vectors)
    whitener, explained = _fit(kept, components)
    result = "vec_id bigint, deviation decimal(38,0), whitened array<double>"
    if whitener is None:
        rows, n, error = spark.createDataFrame([], result), 0, None
    else:
        n, same = whitener.n, kept.where(F.size("embedding") == len(whitener.centre))
        parts = same.mapInArrow(lambda b: _spread(b, whitener), "i int, j int, s double")
        found = {(r["i"], r["j"]): r["s"] / n for r in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}
        error = max(
            abs(value - found[i, -1] * found[j, -1] - (i == j)) for (i, j), value in found.items() if j >= 0
        )
        rows = same.mapInArrow(lambda b: _whitened(b, whitener), result)
    shares = F.array(*[F.lit(e) for e in explained]).cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        "vec_id",
        (F.col("_at") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("_at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
