"""Outputs of several writes that become visible together.

A run writes to a folder of its own. When all its writes have ended, a manifest that names
them is written beside the runs and gets its final name by one rename. Readers take the
newest manifest, so they see all outputs of one run, the one before until the rename and the new
one after it. A run that fails in between leaves a folder that no manifest names.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

from rowsieve.sources.files import names_in, remove, rename, write_text

_MANIFESTS = "_manifests"


def new_run(base: str) -> str:
    """A folder for a run's outputs; later runs sort behind."""
    return f"{base.rstrip('/')}/run-{time.time_ns():020d}-{uuid.uuid4().hex}"


def publish(spark: SparkSession, base: str, outputs: Mapping[str, str]) -> str:
    """Make these outputs the current ones; returns the manifest's path."""
    folder = f"{base.rstrip('/')}/{_MANIFESTS}"
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex}.json"
    write_text(spark, f"{folder}/_{name}", json.dumps(dict(outputs)))
    rename(spark, f"{folder}/_{name}", f"{folder}/{name}")
    return f"{folder}/{name}"


def _manifests(spark: SparkSession, base: str) -> list[str]:
    folder = f"{base.rstrip('/')}/{_MANIFESTS}"
    return [f"{folder}/{name}" for name in names_in(spark, folder) if not name.startswith("_")]


def _outputs(spark: SparkSession, manifest: str) -> dict[str, str]:
    return json.loads(spark.read.text(manifest, wholetext=True).first()["value"])


def published(spark: SparkSession, base: str) -> dict[str, str]:
    """Paths of the current outputs, by name."""
    manifests = _manifests(spark, base)
    if not manifests:
        raise FileNotFoundError(f"nothing is published under {base}")
    return _outputs(spark, manifests[-1])


def retire(spark: SparkSession, base: str, keep: int = 1) -> int:
    """Remove all published runs but the last ``keep``; returns how many went.

    Manifests go before their outputs, so nobody is sent to outputs that are gone. Who still reads a
    run that is removed must start again. Folders that no manifest names stay.
    """
    manifests = _manifests(spark, base)
    old = manifests[: max(len(manifests) - max(keep, 1), 0)]
    in_use = {path for manifest in manifests[len(old) :] for path in _outputs(spark, manifest).values()}
    for manifest in old:
        outputs = _outputs(spark, manifest)
        remove(spark, manifest)
        for path in set(outputs.values()) - in_use:
            remove(spark, path)
    return len(old)
