"""countlens: reports and data-quality checks over fixed-sensor count data,
written as lazy Spark DataFrame plans."""

from countlens.plans.reports import (
    decline_report,
    growth_report,
    top_n_by_day,
    top_n_by_month,
)
from countlens.session import build_session, ensure_checkpoint_dir, scratch_path

__all__ = [
    "build_session",
    "decline_report",
    "ensure_checkpoint_dir",
    "growth_report",
    "scratch_path",
    "top_n_by_day",
    "top_n_by_month",
]
