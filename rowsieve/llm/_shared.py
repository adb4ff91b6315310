"""What the operators of this package share: table reads, staging, worker imports."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.functions import column
from rowsieve.sources.scratch import discard, fresh_path

# Fixed value: what separates words, the ASCII blanks.
BLANK_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


#: Whether shuffle files go as soon as the write that needed them has ended, and how many bytes
#: of rows a Python worker is given at a time.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def small_groups(size: int) -> dict[str, str]:
    """Write options for large rows: a row group ends at ``size`` bytes, a page at a quarter of that, or
    with the row that passes it. Sizes are else looked at every hundred rows, and a file of fewer is one
    page, which writers and readers hold whole, several times over."""
    checks = ("page.size.row.check", "block.size.row.check")
    return {"parquet.block.size": str(size), "parquet.page.size": str(size >> 2)} | {
        f"parquet.{check}.{end}": str(rows) for check in checks for end, rows in (("min", 1), ("max", 100))
    }


def staged(df: DataFrame, label: str, batch_bytes: int | None = None, group_bytes: int | None = None) -> DataFrame:
    """The rows of ``df``, written to the shared scratch folder and read back.

    A staged table cuts the lineage: a lost executor costs its running tasks only. Nothing
    reads its shuffle files after that, so they are removed. ``batch_bytes`` keeps the batches of Python
    workers small where rows are large, ``group_bytes`` what of the table is read or written at once.
    The settings for both hold for this write alone.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, f"llm-{label}")
    values = {CLEANUP: "true"} | ({BATCH_BYTES: str(batch_bytes)} if batch_bytes else {})
    with _settings(spark, values):
        df.write.options(**(small_groups(group_bytes) if group_bytes else {})).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._staged_at = path
    return table


def discarded(*tables: DataFrame) -> None:
    """Remove staged tables that nothing reads any more; other tables are left alone."""
    for table in tables:
        path = getattr(table, "_staged_at", None)
        if path:
            discard(table.sparkSession, path)


def importable_by_workers(spark: SparkSession) -> None:
    """Let Python workers find this library where the session was started elsewhere."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        own = [root, *filter(None, known)]
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(own)


def text_of(name: str = "text") -> Column:
    """The text column, with null as empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def remainder_of_id(modulus: int, name: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo a number: the split into folds."""
    return F.pmod(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(modulus))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def carried(docs: DataFrame) -> DataFrame:
    """Every row as the struct ``row``, with doc_id, its text (null as empty) and a hash of that.

    Columns of any name are out of the way in the struct. The id and the hash together, ``ROW_KEY``,
    tell rows apart but for those equal in id and text.
    """
    whole = F.struct(*[column(c) for c in docs.columns]).alias("row")
    return docs.select(whole, "doc_id", text_of().alias("text"), F.xxhash64(text_of()).alias("tie"))


ROW_KEY = ("doc_id", "tie")


def uncarried(rows: DataFrame, like: DataFrame) -> DataFrame:
    """The rows of ``carried``, with the columns that they had."""
    return rows.select(*[F.col("row")[c].alias(c) for c in like.columns])


def join_by(left: DataFrame, right: DataFrame, how: str, *names: str) -> DataFrame:
    """Join on columns in which null equals null; the left side's stay. For tables of this
    package's own columns."""
    other = right.withColumnsRenamed({name: f"_right_{name}" for name in names})
    on = [left[name].eqNullSafe(other[f"_right_{name}"]) for name in names]
    return left.join(other, on, how).drop(*[f"_right_{name}" for name in names])


def labelled_sample(labelled: DataFrame, docs: DataFrame, most: int, most_bytes: int | None = None) -> DataFrame:
    """(doc_id, tie, target) of at most ``most`` labelled texts, a fixed sample: the least by a hash
    of the id. Of an id with several texts each counts, of equal rows one; ``most_bytes`` leaves longer texts out before
    the choice, so that it has its full size."""
    texts = docs.select("doc_id", F.xxhash64(text_of()).alias("tie"), F.octet_length(text_of()).alias("size"))
    if most_bytes is not None:
        texts = texts.where(F.col("size") <= most_bytes)
    known = labelled.where(F.col("target").isNotNull()).select("doc_id", "target").distinct()
    rows = texts.join(known, "doc_id").select(*ROW_KEY, "target").distinct()
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", "tie", "target").limit(most)
