"""Relational building blocks: period totals, ranking, change, labels, checks."""

from countlens.operators.enrich import bounded_broadcast, with_label, within_bounds
from countlens.operators.periods import day_totals, period_total, present_in_both
from countlens.operators.ordering import placed
from countlens.operators.ranking import rank_by_range, rank_within, top_n_by_period

__all__ = [
    "bounded_broadcast",
    "day_totals",
    "period_total",
    "placed",
    "present_in_both",
    "rank_by_range",
    "rank_within",
    "top_n_by_period",
    "with_label",
    "within_bounds",
]
