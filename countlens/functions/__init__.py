"""Column expressions: date-time parsing / formatting and change arithmetic."""

from countlens.functions.change import difference, percent_of
from countlens.functions.datetime import (
    DATE_FORMAT,
    ISO_LOCAL_FORMAT,
    RAW_COUNT_TIME_FORMAT,
    RAW_COUNT_TIME_FORMAT_PADDED,
    as_local_time,
    day_of,
    fail_if,
    format_iso,
    in_period,
    month_of_day_text,
    months_touching,
    parse_local_time,
    period_bound,
)

__all__ = [
    "DATE_FORMAT",
    "ISO_LOCAL_FORMAT",
    "RAW_COUNT_TIME_FORMAT",
    "RAW_COUNT_TIME_FORMAT_PADDED",
    "as_local_time",
    "day_of",
    "difference",
    "fail_if",
    "format_iso",
    "in_period",
    "month_of_day_text",
    "months_touching",
    "parse_local_time",
    "percent_of",
    "period_bound",
]
