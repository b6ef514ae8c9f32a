"""Arithmetic of period comparisons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def difference(a: Column | str, b: Column | str) -> Column:
    """``a - b``; bigint minus bigint stays bigint (overflow raises under ANSI)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return a - b


def percent_of(part: Column | str, base: Column | str) -> Column:
    """``part / base * 100`` as double; a zero or NULL base gives NULL.

    ``try_divide`` keeps the old non-ANSI result for a zero base instead of
    failing the whole job on one sensor with no traffic in the base year.
    """
    part = F.col(part) if isinstance(part, str) else part
    base = F.col(base) if isinstance(base, str) else base
    return F.try_divide(part.cast("double"), base.cast("double")) * F.lit(100.0)
