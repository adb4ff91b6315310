"""Row rules, lookup enrichment, metrics, checks and profiles over DataFrames."""

from rowsieve.operators.checks import (
    Check,
    Verification,
    check_status,
    evaluate,
    failed_constraints,
    overall_status,
    verify,
)
from rowsieve.operators.enrich import enrich, unmatched
from rowsieve.operators.metrics import (
    ApproxDistinct,
    ApproxQuantile,
    Completeness,
    Compliance,
    Containment,
    Maximum,
    Mean,
    Minimum,
    NonNegative,
    Size,
    StandardDeviation,
    Uniqueness,
    compute_metrics,
)
from rowsieve.operators.preview import preview
from rowsieve.operators.profile import (
    histograms,
    low_cardinality_columns,
    profile_columns,
    profile_table,
    profile_wide,
)
from rowsieve.operators.quantiles import exact_quantiles
from rowsieve.operators.rules import IntRule, RowSchema, Split, StringRule, TimestampRule

__all__ = [
    "ApproxDistinct",
    "ApproxQuantile",
    "Check",
    "Completeness",
    "Compliance",
    "Containment",
    "IntRule",
    "Maximum",
    "Mean",
    "Minimum",
    "NonNegative",
    "RowSchema",
    "Size",
    "Split",
    "StandardDeviation",
    "StringRule",
    "TimestampRule",
    "Uniqueness",
    "Verification",
    "check_status",
    "compute_metrics",
    "enrich",
    "evaluate",
    "exact_quantiles",
    "failed_constraints",
    "histograms",
    "low_cardinality_columns",
    "overall_status",
    "preview",
    "profile_columns",
    "profile_table",
    "profile_wide",
    "unmatched",
    "verify",
]
