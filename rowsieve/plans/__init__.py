"""Whole jobs: gate a table, verify it, profile it. Each scans its source once."""

from rowsieve.plans.jobs import (
    GateOutcome,
    ProfileOutcome,
    published_gate,
    run_gate,
    run_profile,
    run_published_gate,
    run_verification,
)

__all__ = [
    "GateOutcome",
    "ProfileOutcome",
    "published_gate",
    "run_gate",
    "run_profile",
    "run_published_gate",
    "run_verification",
]
