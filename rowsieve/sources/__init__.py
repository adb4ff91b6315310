"""Where rows come from and go to: delimited files, sinks, metric history, ranges."""

from rowsieve.sources.delimited import read_delimited
from rowsieve.sources.history import (
    ResultKey,
    append_metrics,
    append_run_metrics,
    compact_history,
    read_history,
    read_run_metrics,
    run_metrics,
    success_metrics,
)
from rowsieve.sources.publication import new_run, publish, published, retire
from rowsieve.sources.ranges import integer_range
from rowsieve.sources.scratch import discard, fresh_path, scratch_root
from rowsieve.sources.sinks import (
    write_invalid_csv,
    write_profile_json,
    write_valid_csv,
    write_valid_orc,
)

__all__ = [
    "ResultKey",
    "append_metrics",
    "append_run_metrics",
    "compact_history",
    "discard",
    "fresh_path",
    "integer_range",
    "new_run",
    "publish",
    "published",
    "read_delimited",
    "read_history",
    "read_run_metrics",
    "retire",
    "run_metrics",
    "scratch_root",
    "success_metrics",
    "write_invalid_csv",
    "write_profile_json",
    "write_valid_csv",
    "write_valid_orc",
]
