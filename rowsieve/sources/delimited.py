"""Delimited text scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    *,
    sep: str = "\t",
    header: bool = True,
    schema: T.StructType | str | None = None,
    infer: bool = False,
    sampling_ratio: float = 1.0,
    quote: str | None = '"',
    malformed: str | None = None,
    **options: object,
) -> DataFrame:
    """Read delimited files, one split per ``spark.sql.files.maxPartitionBytes``.

    With a ``schema`` there is no extra pass. With neither schema nor ``infer`` all
    columns come as strings under the header's names, which costs a look at the
    first line only and is the right form for row rules. ``infer=True`` reads the
    text once more to guess types (``sampling_ratio`` below 1 guesses from a part).

    ``quote=None`` turns quoting off, so that a field which opens a quote and never
    closes it cannot swallow the rest of its record.

    Every file's header must name the columns in the order they are read in; a file that
    does not fails the read (``enforceSchema=True`` reads by position). ``malformed``
    names a column for the text of records that have more or fewer fields than there are
    columns, null for others, so that a quarantine can hold what was in the file.
    """
    if schema is not None and infer:
        raise ValueError("give a schema or infer=True, not both")
    reader = spark.read.options(header=header, sep=sep, quote="" if quote is None else quote)
    if infer:
        reader = reader.options(inferSchema=True, samplingRatio=sampling_ratio)
    if header:
        reader = reader.option("enforceSchema", False)
    reader = reader.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if malformed is None:
        return reader.csv(path)
    fields = reader.csv(path).schema.fields
    kept = T.StructType([*fields, T.StructField(malformed, T.StringType())])
    return reader.schema(kept).option("columnNameOfCorruptRecord", malformed).csv(path)
