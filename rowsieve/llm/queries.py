"""Registered queries of this package: each operator on its whole table, and the SQL of
those that SQL can express on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.llm import (
    byte_bpe,
    centroid_clusters,
    decontamination,
    jaccard_join,
    ngram_score,
    packing,
    quality_model,
    quality_rules,
    secrets,
    sharding,
    suffix_dedup,
    toxicity,
    whitening,
)
from rowsieve.llm._shared import documents, embeddings, labels, remainder_of_id


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("row.doc_id", *[c for c in found.columns if c not in ("row", "redacted")])


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_score.score_texts(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    known = labels(spark, sf_dir).where(remainder_of_id(5) != 0)
    model = toxicity.train(known.select("doc_id", F.col("toxic").alias("target")), docs)
    return toxicity.score(docs, model).select(
        "doc_id",
        (remainder_of_id(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score_quality(documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "p_good",
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), added_tokens=True)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.find_contamination(documents(spark, sf_dir), benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        "contaminated",
    )


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(documents(spark, sf_dir))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    known = labels(spark, sf_dir).where(remainder_of_id(4) != 2)
    model = quality_model.train(known.select("doc_id", F.col("quality").alias("target")), docs)
    return quality_model.score(docs, model).select(
        "doc_id",
        (remainder_of_id(4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.cluster_vectors(embeddings(spark, sf_dir)).drop("centroid")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(embeddings(spark, sf_dir))
    return whitened.withColumn("deviation", F.col("deviation").cast("bigint"))


def op13_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.decode(byte_bpe.encode(documents(spark, sf_dir))).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scans,
        op2_lm_scoring,
        op3_toxicity,
        op4_quality_rules,
        op5_packing,
        op6_benchmark_decontamination,
        op7_ngram_jaccard_join,
        op8_suffix_array_dedup,
        op9_quality_classifier,
        op10_sharding,
        op11_centroid_clustering,
        op12_embedding_whitening,
        op13_byte_level_bpe,
    )
}


def _clusters_sql(dimensions: int = 64, clusters: int = 8, rounds: int = 10) -> str:
    """SQL of the clustering: one table of distances, of clusters and of centroids a round."""
    steps = [
        f"""kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id,
                   list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE len(embedding) = {dimensions}
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions})""",
        f"points AS MATERIALIZED (SELECT r, d, x[d] AS x FROM kept, range(1, {dimensions} + 1) AS t(d))",
        f"""first AS MATERIALIZED (
            SELECT r, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)), x) - 1 AS c
            FROM kept QUALIFY c < {clusters})""",
        "m0 AS MATERIALIZED (SELECT c, d, x FROM first JOIN points USING (r))",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
            SELECT r, min(apart * {clusters} + c) AS best
            FROM (SELECT r, c, CAST(sum((p.x - m.x) * (p.x - m.x)) AS HUGEINT) AS apart
                  FROM points p JOIN m{i} m USING (d) GROUP BY r, c) GROUP BY r)"""
        )
        if i < rounds:
            steps.append(
                f"""m{i + 1} AS MATERIALIZED (
            SELECT m.c, m.d, coalesce(CAST((s - ((s % n) + n) % n) // n AS BIGINT), m.x) AS x
            FROM m{i} m LEFT JOIN (
                SELECT best % {clusters} AS c, d, sum(x) AS s, count(*) AS n
                FROM a{i} JOIN points USING (r) GROUP BY ALL) USING (c, d))"""
            )
    return f"""WITH {", ".join(steps)},
        named AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS h FROM m{rounds} GROUP BY c),
        final AS (SELECT r, best % {clusters} AS c, best // {clusters} AS apart FROM a{rounds})
        SELECT vec_id, CAST(f.c AS INTEGER) AS cluster, CAST(apart AS BIGINT) AS distance,
               CAST(sum(apart) OVER (PARTITION BY f.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(apart) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
        FROM final f JOIN kept USING (r) JOIN named n ON n.c = f.c"""


ORACLES: dict[str, str] = {
    "op11_centroid_clustering": _clusters_sql(),
    "op6_benchmark_decontamination": r"""
        WITH texts AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        items AS (
            SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        item_windows AS (
            SELECT DISTINCT item_id, least(13, len(w)) AS n,
                   w[i:i + least(13, len(w)) - 1] AS words
            FROM items, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i)
            WHERE len(w) > 0),
        lengths AS (SELECT DISTINCT n FROM item_windows),
        places AS (
            SELECT doc_id, n, i, w[i:i + n - 1] AS words
            FROM texts, lengths, unnest(range(1, len(w) - n + 2)) AS t(i)),
        hits AS (
            SELECT doc_id, item_id, p.n, i
            FROM places p JOIN item_windows x ON p.n = x.n AND p.words = x.words),
        hit_words AS (
            SELECT doc_id, count(DISTINCT j) AS n_hit
            FROM hits, unnest(range(i, i + n)) AS t(j) GROUP BY doc_id),
        hit_items AS (
            SELECT doc_id, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
            FROM hits GROUP BY doc_id)
        SELECT t.doc_id, len(t.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
               coalesce(x.n_items, 0) AS n_items, sha256(coalesce(x.ids, '')) AS items_sha256,
               coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(t.w) AS contaminated
        FROM texts t LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items x USING (doc_id)
    """,
    "op7_ngram_jaccard_join": r"""
        WITH RECURSIVE texts AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        shingles AS MATERIALIZED (
            SELECT DISTINCT doc_id, w[i:i + 2] AS s
            FROM texts, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS t(i) WHERE len(w) > 0),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS MATERIALIZED (
            SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * c.n >= 90 * (x.n + y.n - c.n)),
        reach(a, b) AS (
            SELECT doc_id, doc_id FROM texts
            UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
        SELECT t.doc_id, coalesce(s.n, 0) AS n_shingles, min(reach.b) AS component_id
        FROM texts t LEFT JOIN sizes s USING (doc_id) JOIN reach ON reach.a = t.doc_id
        GROUP BY t.doc_id, s.n
    """,
}
