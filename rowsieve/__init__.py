"""Check, split and profile tables with Spark."""

from rowsieve.operators import *  # noqa: F403
from rowsieve.operators import __all__ as _operators
from rowsieve.plans import run_gate, run_profile, run_verification
from rowsieve.sources import ResultKey, read_delimited, read_history, success_metrics

__all__ = [
    *_operators,
    "ResultKey",
    "read_delimited",
    "read_history",
    "run_gate",
    "run_profile",
    "run_verification",
    "success_metrics",
]
