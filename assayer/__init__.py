"""Declarative data-quality checks and column profiles as Spark jobs."""

from assayer.model import Check, RESULT_COLUMNS
from assayer.plans.run import run_checks
from assayer.plans.manifest import derive_manifest
from assayer.operators.profile import profile, profile_tables

__all__ = [
    "Check",
    "RESULT_COLUMNS",
    "derive_manifest",
    "profile",
    "profile_tables",
    "run_checks",
]
