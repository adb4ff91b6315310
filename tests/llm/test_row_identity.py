"""Rows are judged by their own texts: repeated ids, null ids, and columns with clashing names."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rowsieve.llm import (
    decontamination,
    jaccard_join,
    ngram_score,
    packing,
    quality_model,
    quality_rules,
    secrets,
    sharding,
    toxicity,
)

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, _right_doc_id string, "
    "tie string, node string, odd string, row int, hash int, words string"
)
ITEM = " ".join(f"item{i}" for i in range(20))


def prose(seed, words=80):
    rng = random.Random(seed)
    return ". ".join(
        " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(8))
        for _ in range(words // 8)
    )


GOOD, OTHER, BAD = prose(1), prose(2), "x " * 200
NEAR = GOOD.replace(GOOD.split()[40], "changed", 1)
SECRET = f"{prose(3)} password=abcdefghijkl123 end"


def frame(spark, rows):
    given = [(i, t, "en", "s", None if t is None else len(t), "r", "t", "n", "o", 1, 2, "w") for i, t in rows]
    return spark.createDataFrame(given, SCHEMA).repartition(3)


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def rows_of(*rows):
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, ITEM), (2, None)], "item_id bigint, text string")


def test_rules_judge_each_row(spark):
    docs = frame(spark, [(1, GOOD), (1, BAD), (None, OTHER), (None, BAD), (2, None), (2, ""), (3, GOOD), (3, GOOD)])
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert pairs(kept) == rows_of((1, GOOD), (None, OTHER), (3, GOOD), (3, GOOD))


def test_decontamination_judges_each_row(spark, benchmark):
    dirty = f"{ITEM} and more"
    rows = [(1, dirty), (1, GOOD), (None, dirty), (None, OTHER), (None, None), (2, dirty), (2, dirty)]
    docs = frame(spark, rows)
    found = decontamination.find_contamination(docs, benchmark)
    assert found.columns == ["doc_id", "n_words", "n_hit", "item_ids", "contaminated"]
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"]) for r in found.collect()), key=repr)
    expected = [(i, len((t or "").replace(".", " ").split()), 20 if t == dirty else 0) for i, t in rows]
    assert got == sorted(expected, key=repr)
    clean = decontamination.keep_clean(docs, benchmark)
    assert clean.columns == docs.columns
    assert pairs(clean) == rows_of((1, GOOD), (None, OTHER), (None, None))


def test_a_text_that_goes_in_circles_costs_no_more(spark):
    """1600 equal words against an item of 400: as many rows as places, not pairs of places."""
    item = spark.createDataFrame([(1, "do " * 400), (2, "do " * 12 + "x")], "item_id bigint, text string")
    docs = frame(spark, [(1, "do " * 1600), (2, "do " * 12), (3, "la " * 50 + "do " * 13)])
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"]) for r in decontamination.find_contamination(docs, item).collect()}
    assert got == {1: (1600, 1600, ["1"]), 2: (12, 0, []), 3: (63, 13, ["1"])}


def test_one_row_of_each_group_stays(spark):
    rows = [(5, GOOD), (1, NEAR), (7, OTHER), (7, GOOD), (None, OTHER), (None, GOOD), (None, None), (None, None)]
    rows += [(9, prose(4)), (9, prose(4)), (9, prose(5)), (8, ""), (8, "")]
    docs = frame(spark, rows)
    kept = jaccard_join.keep_one(docs, words=5, least=80)
    assert kept.columns == docs.columns
    got = pairs(kept)
    assert [p for p in got if p[1] in (GOOD, NEAR)] == [(1, NEAR)]
    assert len([p for p in got if p[1] == OTHER]) == 1
    rest = [p for p in got if p[1] not in (GOOD, NEAR, OTHER)]
    assert rest == rows_of((None, None), (None, None), (9, prose(4)), (9, prose(5)), (8, ""), (8, ""))


def test_scans_and_scores_are_by_row(spark):
    rows = [(1, SECRET), (1, GOOD), (None, SECRET), (None, None), (2, GOOD), (2, GOOD)]
    docs = frame(spark, rows)
    found = secrets.scan(docs).collect()
    assert sorted(r["n_assign"] for r in found) == [0, 0, 0, 0, 1, 1]
    assert all(bool(r["n_assign"]) == (r["row"]["text"] == SECRET) for r in found)
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns and sum("[secret]" in (t or "") for _, t in pairs(clean)) == 2

    scored = ngram_score.score_texts(docs).collect()
    assert len(scored) == len(rows)
    by_text = {}
    for r in scored:
        by_text.setdefault(r["n_tokens"], set()).add(round(r["base_score"], 9))
    assert all(len(values) == 1 for values in by_text.values())
    sizes = sorted(len((t or "").split()) + 1 for _, t in rows)
    assert sorted(r["n_tokens"] for r in scored) == sizes

    packed = packing.pack(docs).collect()
    assert len(packed) == len(rows) and sum(r["doc_id"] in (None, "None") for r in packed) == 2

    shards = sharding.shard_rows(docs, shards=3).collect()
    crc = sorted(zlib.crc32((t or "").encode()) for _, t in rows)
    assert sorted(r["text_crc32"] for r in shards) == crc


def test_classifiers_learn_from_repeated_and_null_ids(spark):
    """Bounded samples: a repeated id does not bring more rows than asked for."""
    good = [(i % 20, prose(100 + i)) for i in range(60)]
    bad = [(20 + i % 20, prose(200 + i).replace(" ", "%% idiot ", 30)) for i in range(60)]
    docs = frame(spark, [*good, *bad, (None, GOOD), (None, None), (3, prose(103)), (3, prose(103))])
    marks = spark.createDataFrame([(i, int(i < 20)) for i in range(40)] + [(None, 1), (5, None)], "doc_id bigint, target int")
    sample = quality_model.labelled_sample(marks, docs, 30)
    assert sample.count() == 30 and sample.distinct().count() == 30
    short = quality_model.labelled_sample(marks, docs, 1000, most_bytes=700).collect()
    assert 0 < len(short) < 120
    model = quality_model.train(marks, docs)
    scores = quality_model.score(docs, model).collect()
    assert len(scores) == docs.count()
    assert all((r["score"] >= 0.7) == (r["doc_id"] < 20) for r in scores if r["doc_id"] is not None)
    toxic = marks.withColumn("target", 1 - F.col("target"))
    scores = toxicity.score(docs, toxicity.train(toxic, docs)).collect()
    assert len(scores) == docs.count()
    assert all((r["score"] >= 0.5) == (r["doc_id"] >= 20) for r in scores if r["doc_id"] is not None)


def test_scores_are_the_plain_formulas(spark):
    """A reference scorer over whole texts: every input pair, every window that counts."""
    docs = frame(spark, [(i, prose(i, 16 + 24 * i)) for i in range(6)] + [(6, ""), (7, "one")])
    model = quality_model.FactorisationMachine()
    rng = np.random.default_rng(4)
    model.weight[:] = rng.normal(0, 0.1, len(model.weight))
    model.factor[:] = rng.normal(0, 0.1, model.factor.shape)
    extract = quality_model.Extractor()
    for r in quality_model.score(docs, model).join(docs.select("doc_id", "text", "n_chars"), "doc_id").collect():
        index, value = model.inputs(*extract(r["text"] or "", r["n_chars"]))
        odds = float(model.bias) + float(model.weight[index] @ value)
        for i in range(len(index)):
            for j in range(i):
                odds += float(model.factor[index[i]] @ model.factor[index[j]]) * value[i] * value[j]
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-odds)), rel=1e-3)

    net = toxicity.Network()
    for r in toxicity.score(docs, net).join(docs.select("doc_id", "text"), "doc_id").collect():
        words = (r["text"] or "").encode().lower().split()
        best = -np.inf if words else float(net.p["bias"][0])
        for start in range(max(len(words) - toxicity.WINDOW, 0) + 1 if words else 0):
            part = words[start : start + toxicity.WINDOW]
            pad = toxicity.WINDOW - len(part)
            given = np.concatenate([net.projected(part), np.zeros((pad, 6 * toxicity.HIDDEN), np.float32)])
            mask = np.array([[1.0] * len(part) + [0.0] * pad], np.float32)
            best = max(best, float(net.odds(given[None], mask)[0]))
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-best)), rel=1e-3)


def test_pipeline_over_odd_rows_and_an_empty_table(spark, tmp_path, benchmark):
    rows = [(1, GOOD), (1, BAD), (None, OTHER), (None, BAD), (2, f"{ITEM} " * 6), (2, SECRET), (3, NEAR), (4, None)]
    for name, given in (("odd", rows), ("none", [])):
        sf_dir = str(tmp_path / name)
        frame(spark, given).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{sf_dir}/documents.parquet")
        benchmark.write.parquet(f"{sf_dir}/benchmark.parquet")
    packed = corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()
    reader = packing._Encoder.load(packing.VOCABULARY, True)
    # With the junk under id 1 gone, that id names one row, and it comes before its near copy.
    kept = [GOOD, OTHER, SECRET.replace("password=abcdefghijkl123", "[secret]")]
    sizes = sorted(len(reader(t)) + 1 for t in kept)
    assert sorted(r["doc_tokens"] for r in packed) == sizes
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
