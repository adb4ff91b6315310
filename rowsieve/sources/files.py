"""Small steps on the file system that holds a path: list names, rename, write one small file."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str) -> tuple:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    files, at = _place(spark, folder)
    return sorted(f.getPath().getName() for f in files.listStatus(at)) if files.exists(at) else []


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _place(spark, path)
    return files.exists(at)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Give a file or folder its final name, which nothing may have yet."""
    files, at = _place(spark, old)
    if exists(spark, new) or not files.rename(at, _place(spark, new)[1]):
        raise OSError(f"{old} could not be renamed to {new}")


def remove(spark: SparkSession, path: str) -> None:
    files, at = _place(spark, path)
    files.delete(at, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not be there yet."""
    files, at = _place(spark, path)
    out = files.create(at, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
