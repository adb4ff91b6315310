"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read back as the next one's documents. All but the last return the columns
that documents have.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowsieve.llm import decontamination, jaccard_join, packing, quality_rules, secrets
from rowsieve.llm._shared import documents, staged

#: Near duplicates have this similarity or more, in hundredths, on shingles of so many words.
SHINGLE_WORDS, LEAST_SIMILAR = 5, 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the label model rejects."""
    return quality_rules.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates."""
    return jaccard_join.keep_one(docs, words=SHINGLE_WORDS, least=LEAST_SIMILAR)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth are benchmark passages."""
    return decontamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark in their texts."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document: where it lies in the training sequences."""
    return packing.pack(docs, added_tokens=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", good_documents),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", uncontaminated),
    ("secret_scans", without_secrets),
    ("packing", packed),
]

#: Tokenizing and the label model's estimates are beyond SQL: tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
