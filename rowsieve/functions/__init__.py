"""Column expressions shared by the operators. All are built-in Spark functions."""

from rowsieve.functions.scalar import (
    cases,
    column,
    column_label,
    day_of_millis,
    elapsed_seconds,
    file_stamp,
    int_value,
    literal_rows,
    masked_timestamp,
    non_negative,
    number_value,
    pattern_found,
    share_of,
    type_class,
)

__all__ = [
    "cases",
    "column",
    "column_label",
    "day_of_millis",
    "elapsed_seconds",
    "file_stamp",
    "int_value",
    "literal_rows",
    "masked_timestamp",
    "non_negative",
    "number_value",
    "pattern_found",
    "share_of",
    "type_class",
]
