"""Where staging tables and round trips are written.

A staging table must be on storage that every executor sees, so its root is the
folder the cluster names in ``spark.checkpoint.dir``. Only a local-mode session
without that setting falls back to the machine's temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_ROOT = "rowsieve.scratch.local"


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(LOCAL_ROOT, None)
    if root:
        return root.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        root = tempfile.mkdtemp(prefix="rowsieve-")
        spark.conf.set(LOCAL_ROOT, root)
        return root
    raise RuntimeError(
        "set spark.checkpoint.dir to a folder on shared storage; staging tables are written there"
    )


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path that no other run uses, so nothing that is being read gets overwritten."""
    return f"{scratch_root(spark)}/rowsieve/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that ``fresh_path`` named, once nothing reads it any more."""
    if not path.startswith(f"{scratch_root(spark)}/rowsieve/"):
        raise ValueError(f"{path} is not a scratch table")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(hadoop, True)
