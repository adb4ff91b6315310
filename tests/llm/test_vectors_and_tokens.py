"""Clustering, whitening and byte-level BPE against brute force; odd rows, empty tables."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from rowsieve.llm import byte_bpe, centroid_clusters, feast, whitening

VECTORS = "vec_id bigint, embedding array<float>, label int, cluster int, n int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, 3) for i, v in rows], VECTORS)


def some_rows(rng, n, d, spread=1.0):
    return [(int(i), rng.standard_normal(d) * spread + np.arange(d) % 3) for i in range(n)]


def odd_rows(d):
    inf, nan = float("inf"), float("nan")
    base = [0.25] * (d - 1)
    return [(900, None), (901, [*base, None]), (902, [*base, nan]), (903, [*base, -inf])]


def lloyd(rows, d, clusters=8, rounds=10):
    """Plain k-means on Python integers."""
    kept = [
        (i, [int(np.floor(1024 * float(np.float32(x)))) for x in v])
        for i, v in rows
        if v is not None and len(v) == d and all(x is not None and np.isfinite(x) for x in v)
    ]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(x) for _, x in first[:clusters]]

    def assign():
        out = []
        for _, x in kept:
            apart = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids]
            out.append((min(apart), apart.index(min(apart))))
        return out

    for _ in range(rounds):
        told = assign()
        for c in range(len(centroids)):
            own = [x for (_, x), (_, k) in zip(kept, told) if k == c]
            if own:
                centroids[c] = [sum(col) // len(own) for col in zip(*own)]
    told = assign()
    out = []
    for (i, _), (apart, c) in zip(kept, told):
        inertia = sum(a for a, k in told if k == c)
        name = hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
        out.append((i, c, apart, inertia, sum(a for a, _ in told), name))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n, d, chunk", [(150, 8, 16384), (150, 8, 7), (5, 8, 16384), (1, 3, 4)])
def test_clusters_equal_plain_integers(spark, n, d, chunk):
    rng = np.random.default_rng(n)
    rows = some_rows(rng, n, d)
    rows += [(i + 1000, rows[0][1]) for i in range(n // 2)]  # copies of one vector
    rows += [rows[0], (rows[0][0], rows[-1][1] + 1), (None, rows[0][1] * 2), (950, [0.5] * (d + 1)), (951, [])]
    rows += odd_rows(d)
    found = centroid_clusters.cluster_vectors(vectors(spark, rows), dimensions=d, chunk=chunk)
    got = [
        (r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"])
        for r in found.collect()
    ]
    assert sorted(got, key=repr) == lloyd(rows, d)
    for r in found.limit(3).collect():
        assert hashlib.sha256(",".join(map(str, r["centroid"])).encode()).hexdigest() == r["centroid_sha256"]


def test_ties_go_to_the_smaller_centroid_and_empty_ones_stay(spark):
    rows = [(i, [1.0, -2.5]) for i in range(12)]
    found = centroid_clusters.cluster_vectors(vectors(spark, rows), dimensions=2).collect()
    assert {(r["cluster"], r["distance"], tuple(r["centroid"])) for r in found} == {(0, 0, (1024, -2560))}
    assert len(found) == 12


def test_dictionaries_lose_nothing_and_widen_for_copies():
    rng = np.random.default_rng(3)
    for x in (
        rng.integers(-9, 9, (500, 12)),
        np.repeat(rng.integers(-(1 << 27), 1 << 27, (3, 12)), 200, axis=0),
        rng.integers(-5, 5, (1, 12)),
    ):
        n, blocks = centroid_clusters.unpacked(centroid_clusters.packed([None] * len(x), x).to_pylist()[0])
        assert n == len(x) and (np.hstack([entries[codes] for entries, codes in blocks]) == x).all()
        centroids = x[rng.integers(0, len(x), 4)]
        cluster, distance = centroid_clusters.nearest(n, blocks, centroids)
        apart = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        assert (cluster == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
        own = np.stack([x[cluster == c].sum(axis=0) for c in range(4)])
        assert (centroid_clusters.sums(blocks, cluster, 4) == own).all()
    copies = np.repeat(rng.integers(0, 99, (3, 12)), 200, axis=0)
    assert [entries.shape for entries, _ in centroid_clusters.dictionaries(copies)] == [(3, 12)]
    assert max(e.shape[1] for e, _ in centroid_clusters.dictionaries(rng.integers(0, 500, (2000, 12)))) == 1


def test_no_vectors_and_too_large_ones(spark):
    none = vectors(spark, [])
    assert centroid_clusters.cluster_vectors(none).count() == 0
    assert centroid_clusters.cluster_vectors(vectors(spark, odd_rows(64))).count() == 0
    assert whitening.whiten(none).count() == 0
    assert whitening.whiten(vectors(spark, odd_rows(64))).count() == 0
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256"]
    assert centroid_clusters.cluster_vectors(none).columns == columns
    for run in (lambda v: centroid_clusters.cluster_vectors(v, dimensions=2), whitening.whiten):
        with pytest.raises(Exception, match="64 bits"):
            run(vectors(spark, [(1, [1e30, 2.0]), (2, [0.0, 1.0])])).collect()


def test_eigenpairs_of_many_kinds():
    rng = np.random.default_rng(8)
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    spectra = [
        np.arange(40.0),
        np.repeat([5.0, 3.0, 1.0, 0.5], 10),
        2.0 ** -np.arange(40),
        np.r_[1e6, 1 + 1e-7 * rng.random(39)],
        np.r_[[3.0, 2.0], np.zeros(38)],
        np.ones(40),
    ]
    for spectrum in spectra:
        matrix = (q * spectrum) @ q.T
        matrix = (matrix + matrix.T) / 2
        true = np.linalg.eigvalsh(matrix)[::-1]
        values, own = feast.leading(matrix, 32)
        top = true[0]
        assert len(values) == min(32, int((spectrum > 1e-13 * top).sum()))
        assert np.abs(values - true[: len(values)]).max() <= 1e-13 * top
        assert np.abs(own.T @ own - np.eye(len(values))).max() <= 1e-13
        assert np.abs(matrix @ own - own * values).max() <= 1e-13 * top
        for shift in (top / 3 + 1e-3, top * 0.77, -1.0, top + 1):
            assert feast.below(matrix, shift) == int((true < shift).sum())
    assert feast.leading(np.zeros((3, 3)), 2)[0].size == 0


@pytest.mark.parametrize("n, d, components", [(300, 48, 32), (20, 48, 32), (60, 5, 32), (300, 12, 3)])
def test_whitening_equals_a_dense_solution(spark, n, d, components):
    rng = np.random.default_rng(n + d)
    rows = some_rows(rng, n, d, spread=np.linspace(1, 4, d))
    rows += [rows[3], (None, rows[4][1] + 1)]
    given = vectors(spark, [*rows, *odd_rows(d), (960, [1.0] * (d + 2)), (961, [])])
    got = whitening.whiten(given, components).collect()
    x = np.floor(64 * np.array([v for _, v in rows]).astype(np.float32).astype(float)).astype(np.int64) + 1_000_000
    m, total = len(x), x.sum(axis=0)
    centred = (m * x - total) / m
    covariance = centred.T @ centred / m
    values, own = np.linalg.eigh(covariance)
    values, own = values[::-1], own[:, ::-1]
    k = min(components, d, n)  # n + 1 distinct rows
    assert len(got) == k * m and {r["component"] for r in got} == set(range(1, k + 1))
    plain = centred @ own / np.sqrt(np.maximum(values, 1e-300))
    deviations = sorted(int(sum((m * int(a) - int(s)) ** 2 for a, s in zip(row, total))) for row in x)
    for c in range(k):
        mine = sorted((r for r in got if r["component"] == c + 1), key=lambda r: r["whitened"])
        ours, theirs = np.array([r["whitened"] for r in mine]), np.sort(plain[:, c])
        assert min(np.abs(ours - theirs).max(), np.abs(ours + theirs[::-1]).max()) < 1e-7
        assert abs(mine[0]["explained"] / (values[c] / np.trace(covariance)) - 1) < 1e-9
        assert sorted(int(r["deviation"]) for r in mine) == deviations
    assert {r["n"] for r in got} == {m} and len({r["identity_error"] for r in got}) == 1
    assert got[0]["identity_error"] < 1e-9


def test_exact_products_of_large_numbers():
    rng = np.random.default_rng(2)
    for most in (50, 1 << 20, 1 << 27):
        y = rng.integers(-most, most, (700, 3))
        exact = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(3)] for i in range(3)]
        assert whitening.gram(y).tolist() == exact


def test_equal_rows_have_no_component(spark):
    assert whitening.whiten(vectors(spark, [(i, [1.5, 2.5]) for i in range(9)])).count() == 0


def test_pieces_give_the_ids_of_the_whole_text():
    codec = byte_bpe.Codec.load(None)
    rng = random.Random(11)
    signs = "ab1 2 \n\t'sé你　\x85\x1c\x1f!.​\xa0 're  ᠎﻿"
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 60)))
        most, blanks = rng.randint(1, 10), rng.randint(2, 5)
        assert "".join(p for p, _ in byte_bpe.pieces(text, most, blanks)) == text
        ids = codec.encode(text, most, blanks)
        assert ids.tolist() == codec.matched.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_round_trip_of_documents(spark):
    long = ["word " * 60_000, " " * 1_500_000 + "x", "x" + "\n" * 20_000, "a" * 300_000, "你好。" * 50_000]
    odd = [None, "", " ", "<|endoftext|>", "it's\r\n\tI'LL", "\x00\x7f é 😀", "same", "same"]
    rows = [(i % 9 or None, t, "x", 5, b"") for i, t in enumerate([*odd, *long])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, n_tokens int, decoded binary")
    out = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    got = sorted(((r["doc_id"], bytes(r["decoded"]).decode()) for r in out), key=key)
    assert got == sorted(((i, t or "") for i, t, *_ in rows), key=key)
    codec = byte_bpe.Codec.load(None)
    for r in out:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["n_tokens"]
        if len(r["decoded"]) < 1000:
            assert ids.tolist() == codec.matched.encode_ordinary(bytes(r["decoded"]).decode())
    assert byte_bpe.decode(byte_bpe.encode(docs.limit(0))).count() == 0
    own = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert byte_bpe.decode(own, public_tokenizers.path("byte_bpe_50k.tiktoken")).count() == len(rows)


def test_ids_cut_inside_a_character_decode_to_raw_bytes(spark):
    codec = byte_bpe.Codec.load(None)
    ids = codec.encode("\U0001f9ff")
    assert len(ids) > 1
    rows = [(1, 1, ids[:1].tobytes()), (2, None, None)]
    cut = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, ids binary")
    out = {r["doc_id"]: r["decoded"] for r in byte_bpe.decode(cut).collect()}
    assert "\U0001f9ff".encode().startswith(bytes(out[1])) and out[2] is None
