"""Sinks for typed valid rows, quarantined rows and profiles.

Each is one distributed write. None repartitions: the number of output files
follows the splits of the input, which at 100 TB is what keeps writers parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.functions import file_stamp


def write_valid_orc(valid: DataFrame, out_dir: str, name: str) -> str:
    path = f"{out_dir.rstrip('/')}/{name}_valid_orc"
    valid.write.mode("overwrite").orc(path)
    return path


def write_valid_csv(valid: DataFrame, out_dir: str, name: str) -> str:
    """Valid rows as CSV without a header."""
    path = f"{out_dir.rstrip('/')}/{name}_valid_csv"
    valid.write.mode("overwrite").csv(path)
    return path


def write_invalid_csv(invalid: DataFrame, out_dir: str, name: str) -> str:
    """Invalid rows as CSV without a header; CSV has no arrays, so reasons are joined."""
    path = f"{out_dir.rstrip('/')}/{name}_invalid"
    flat = [
        F.concat_ws("|", F.col(f"`{field.name}`")).alias(field.name)
        if field.dataType.typeName() == "array"
        else F.col(f"`{field.name}`")
        for field in invalid.schema
    ]
    invalid.select(*flat).write.mode("overwrite").csv(path)
    return path


def write_profile_json(
    profile: DataFrame, out_dir: str, dataset: str, instant: str, *, part: str = ""
) -> str:
    """Column profiles (or a further part of them) as JSON, named by the run's instant."""
    path = f"{out_dir.rstrip('/')}/profile/{file_stamp(instant)}_{dataset}{part}.json"
    profile.withColumn("run_ts", F.lit(instant)).write.mode("errorifexists").json(path)
    return path
