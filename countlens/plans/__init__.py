"""Composite plans: the four reports and the end-to-end jobs."""

from countlens.plans.reports import (
    decline_report,
    growth_report,
    top_n_by_day,
    top_n_by_month,
    top_n_from_day_totals,
)

__all__ = [
    "decline_report",
    "growth_report",
    "top_n_by_day",
    "top_n_by_month",
    "top_n_from_day_totals",
]
