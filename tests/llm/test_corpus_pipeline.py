"""The pipeline against its operators, stage by stage, on the small tables."""

from __future__ import annotations

import corpus_pipeline
from rowsieve.llm import decontamination, jaccard_join, quality_rules, secrets
from rowsieve.llm._shared import documents, staged

SF_DIR = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = documents(spark, SF_DIR)
    columns, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name == "quality_rules":
            judged = quality_rules.score_quality(docs)
            keep = {r["doc_id"] for r in judged.where("kept").select("doc_id").collect()}
        elif name == "ngram_jaccard_join":
            groups = jaccard_join.link_documents(
                docs, words=corpus_pipeline.SHINGLE_WORDS, least=corpus_pipeline.LEAST_SIMILAR
            )
            keep = {r["doc_id"] for r in groups.where("doc_id = component_id").collect()}
        elif name == "benchmark_decontamination":
            found = decontamination.find_contamination(docs, spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))
            keep = {r["doc_id"] for r in found.where("not contaminated").collect()}
        else:
            keep = before
        docs = staged(stage(spark, docs, SF_DIR), name)
        ids[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and ids[name] == keep and keep <= before
    for row in docs.collect():
        assert secrets.base_spans(row["text"]) == []
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == ids["secret_scans"]
