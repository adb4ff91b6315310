"""Exact k-means of integer vectors by subvector dictionaries.

Vectors are cut into chunks of a bounded number of rows. In each chunk the dimensions are
cut into blocks, and each block is encoded without loss: its distinct subvectors are a
dictionary, and a vector holds one code per block. Blocks begin with one dimension each; two
neighbours become one where the wider dictionary costs less work a round than one more code
per vector, so chunks of copies get wide blocks and varied ones narrow blocks.

The encoded chunks are written once. A round computes the exact distance of every dictionary
entry to every centroid's part, once, and a vector's distance is the sum of its codes'
partial distances. New centroids come from the same codes: how often an entry occurs in a
cluster, times the entry. A task sends one row per cluster, so neither copies nor a large cluster
make a large group; the driver sees clusters times dimensions numbers a round.

All arithmetic is on integers. A vector is kept if it has exactly ``dimensions`` components, none
null, NaN or infinite; a component x becomes floor(scale * x). Components may be up to 2^27
in magnitude then, else distances would leave 64 bits: larger ones end the job with an
error. Ties go to the smaller centroid number. Centroids start as the vectors with the least SHA-256
of a salt and their id; of rows that repeat an id the lesser vector comes first, and rows without an
id come last of all. With fewer vectors than centroids there are as many centroids as vectors.
A centroid without vectors stays where it is. Rows that repeat an id are vectors each. An empty table
gives an empty result. Columns other than ``vec_id`` and ``embedding`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm._shared import importable_by_workers, staged

DIMENSIONS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SALT = "3:"
#: Vectors of a chunk at most.
CHUNK = 16_384
LARGEST = 1 << 27

CHUNKS = pa.schema(
    [
        ("vec_ids", pa.list_(pa.int64())),
        ("widths", pa.list_(pa.int32())),
        ("sizes", pa.list_(pa.int32())),
        ("entries", pa.binary()),
        ("codes", pa.binary()),
    ]
)
CHUNK_COLUMNS = "vec_ids array<bigint>, widths array<int>, sizes array<int>, entries binary, codes binary"

Block = tuple[np.ndarray, np.ndarray]


def dictionaries(x: np.ndarray) -> list[Block]:
    """(distinct subvectors, codes) of neighbouring blocks of the columns of ``x``."""
    blocks: list[Block] = []
    for column in x.T:
        entries, codes = np.unique(column, return_inverse=True)
        blocks.append((entries.reshape(-1, 1), codes))
    merging = True
    while merging:
        merging, wider, at = False, [], 0
        while at < len(blocks):
            pair = blocks[at : at + 2]
            joined = _joined(*pair) if len(pair) == 2 else None
            if joined:
                wider.append(joined)
                merging, at = True, at + 2
            else:
                wider.append(pair[0])
                at += 1
        blocks = wider
    return blocks


def _joined(left: Block, right: Block) -> Block | None:
    """Two blocks as one, if entries and codes then cost less work together."""
    (a, i), (b, j) = left, right
    both, codes = np.unique(i.astype(np.int64) * len(b) + j, return_inverse=True)
    width = a.shape[1] + b.shape[1]
    if len(both) * width + len(codes) >= a.size + b.size + 2 * len(codes):
        return None
    return np.hstack([a[both // len(b)], b[both % len(b)]]), codes


def _code_kind(size: int) -> str:
    return "<u1" if size <= 1 << 8 else "<u2" if size <= 1 << 16 else "<u4"


def packed(vec_ids: list[int | None], x: np.ndarray) -> pa.RecordBatch:
    """A chunk as one row."""
    blocks = dictionaries(x)
    row = {
        "vec_ids": vec_ids,
        "widths": [entries.shape[1] for entries, _ in blocks],
        "sizes": [len(entries) for entries, _ in blocks],
        "entries": b"".join(entries.astype("<i4").tobytes() for entries, _ in blocks),
        "codes": b"".join(codes.astype(_code_kind(len(entries))).tobytes() for entries, codes in blocks),
    }
    return pa.RecordBatch.from_pylist([row], CHUNKS)


def unpacked(row: dict) -> tuple[int, list[Block]]:
    """Number of vectors and the blocks of a chunk's row."""
    n, blocks, entries_at, codes_at = len(row["vec_ids"]), [], 0, 0
    for width, size in zip(row["widths"], row["sizes"]):
        entries = np.frombuffer(row["entries"], "<i4", width * size, entries_at).reshape(size, width)
        kind = np.dtype(_code_kind(size))
        blocks.append((entries.astype(np.int64), np.frombuffer(row["codes"], kind, n, codes_at)))
        entries_at += 4 * width * size
        codes_at += kind.itemsize * n
    return n, blocks


def nearest(n: int, blocks: list[Block], centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest centroid of each vector of a chunk."""
    total = np.zeros((n, len(centroids)), np.int64)
    at = 0
    for entries, codes in blocks:
        part = centroids[:, at : at + entries.shape[1]]
        apart = np.stack([((entries - c) ** 2).sum(axis=1) for c in part], axis=1)
        total += apart[codes]
        at += entries.shape[1]
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(n), cluster]


def sums(blocks: list[Block], cluster: np.ndarray, clusters: int) -> np.ndarray:
    """Componentwise sums of the vectors of each cluster, from how often entries occur there."""
    out = []
    for entries, codes in blocks:
        often = np.bincount(codes.astype(np.int64) * clusters + cluster, minlength=len(entries) * clusters)
        out.append(often.reshape(len(entries), clusters).T @ entries)
    return np.hstack(out)


def _encoded(batches: Iterator[pa.RecordBatch], dimensions: int, scale: int, most: int) -> Iterator[pa.RecordBatch]:
    ids: list[int | None] = []
    parts: list[np.ndarray] = []

    def done(n: int) -> pa.RecordBatch:
        nonlocal ids, parts
        x = np.concatenate(parts)
        chunk = packed(ids[:n], x[:n])
        ids, parts = ids[n:], [x[n:]]
        return chunk

    for batch in batches:
        values = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        x = np.floor(values * scale).reshape(-1, dimensions)
        if np.abs(x).max(initial=0) > LARGEST:
            raise ValueError(f"a component times {scale} is beyond {LARGEST}: distances would leave 64 bits")
        ids += batch.column(0).to_pylist()
        parts.append(x.astype(np.int64))
        while len(ids) >= most:
            yield done(most)
    if ids:
        yield done(len(ids))


def _totals(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per cluster of this task: vectors, summed distances, componentwise sums."""
    k = len(centroids)
    n, inertia, total = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros(centroids.shape, np.int64)
    for batch in batches:
        for row in batch.to_pylist():
            size, blocks = unpacked(row)
            cluster, distance = nearest(size, blocks, centroids)
            n += np.bincount(cluster, minlength=k)
            np.add.at(inertia, cluster, distance)
            total += sums(blocks, cluster, k)
    full = np.flatnonzero(n)
    if len(full):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(full.astype(np.int32)),
                pa.array(n[full]),
                pa.array(inertia[full]),
                pa.array(total[full].tolist(), pa.list_(pa.int64())),
            ],
            ["cluster", "n", "inertia", "sums"],
        )


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            cluster, distance = nearest(*unpacked(row), centroids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["vec_ids"], pa.int64()), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                ["vec_id", "cluster", "distance"],
            )


def usable(vectors: DataFrame, dimensions: int) -> DataFrame:
    """vec_id and embedding of the vectors that are kept."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    return kept.where((F.size("embedding") == dimensions) & finite)


def first_centroids(kept: DataFrame, clusters: int, scale: int, salt: str) -> np.ndarray:
    """Vectors with the least hashes of their ids."""
    code = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    rows = kept.select(code.alias("code"), whole.alias("x"))
    rows = rows.orderBy(F.asc_nulls_last("code"), "x").limit(clusters).collect()
    return np.array([r["x"] for r in rows], np.int64)


def cluster_vectors(
    vectors: DataFrame,
    dimensions: int = DIMENSIONS,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    salt: str = SALT,
    chunk: int = CHUNK,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid (its components) and
    centroid_sha256, one row per kept vector."""
    spark = vectors.sparkSession
    importable_by_workers(spark)
    kept = usable(vectors, dimensions)
    centroids = first_centroids(kept, clusters, scale, salt)
    encoded = staged(kept.mapInArrow(lambda b: _encoded(b, dimensions, scale, chunk), CHUNK_COLUMNS), "subvectors")
    result = "vec_id bigint, cluster int, distance bigint"
    if not len(centroids):
        none = spark.createDataFrame([], result)
        return none.select(
            "*",
            F.lit(None).cast("bigint").alias("cluster_inertia"),
            F.lit(None).cast("bigint").alias("inertia"),
            F.lit(None).cast("array<bigint>").alias("centroid"),
            F.lit(None).cast("string").alias("centroid_sha256"),
        )

    def totals(at: np.ndarray) -> DataFrame:
        return encoded.mapInArrow(lambda b: _totals(b, at), "cluster int, n bigint, inertia bigint, sums array<bigint>")

    exact = "decimal(38,0)"
    for _ in range(rounds):
        parts = totals(centroids).select("cluster", "n", F.posexplode("sums").alias("dimension", "x"))
        moved = centroids.copy()
        for r in (
            parts.groupBy("cluster", "dimension")
            .agg(F.sum("n").alias("n"), F.sum(F.col("x").cast(exact)).alias("x"))
            .collect()
        ):
            moved[r["cluster"], r["dimension"]] = int(r["x"]) // r["n"]
        centroids = moved
    last = totals(centroids).groupBy("cluster").agg(F.sum(F.col("inertia").cast(exact)).alias("inertia")).collect()
    inertia = {r["cluster"]: int(r["inertia"]) for r in last}

    def of_cluster(values: list, kind: str) -> F.Column:
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster"))

    texts = [",".join(map(str, c.tolist())) for c in centroids]
    return encoded.mapInArrow(lambda b: _assigned(b, centroids), result).select(
        "*",
        of_cluster([inertia.get(c, 0) for c in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        F.transform(F.split(of_cluster(texts, "string"), ","), lambda x: x.cast("bigint")).alias("centroid"),
        of_cluster([hashlib.sha256(t.encode()).hexdigest() for t in texts], "string").alias("centroid_sha256"),
    )
