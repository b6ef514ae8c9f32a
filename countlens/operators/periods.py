"""Period totals: sum of a count per key inside a half-open time range."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countlens.functions.datetime import day_of, day_text_of, in_period, months_touching

# Rows that one task groups: a million groups take about 0.3 GB of its memory.
ROWS_PER_TASK = 1_000_000
# From so many rows a group on, a sum per task before the shuffle saves most of the shuffle.
ROWS_PER_GROUP = 4


def period_total(
    df: DataFrame,
    ts_col: str,
    start: str,
    end: str,
    id_col: str,
    value_col: str,
    out: str,
    month_col: str | None = None,
) -> DataFrame:
    """``sum(value_col)`` per ``id_col`` for rows with ``start <= ts_col < end``.

    The range filter reaches the Parquet scan as pushed predicates; the sum
    runs as a partial (map-side) plus final hash aggregate, so a hot key is
    collapsed to one row per task before it is shuffled. ``month_col`` names
    a ``yyyy-MM`` partition column derived from ``ts_col``; when given, the
    months outside the period are pruned before any file is read.
    """
    cond = in_period(df, ts_col, start, end)
    if month_col:
        cond = months_touching(month_col, start, end) & cond
    return (
        df.filter(cond)
        .groupBy(id_col)
        .agg(F.sum(value_col).alias(out))
    )


def day_totals(
    df: DataFrame,
    ts_col: str,
    id_col: str,
    value_col: str,
    day_col: str = "day",
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """``sum(value_col)`` and the row count per (calendar day, day text, ``id_col``).

    The shared first step of the daily ranking and of any change report whose
    period bounds are days: those period totals are sums of day totals, so one
    scan of the raw counts serves all of them. A period takes rows by
    ``day_text`` (the stored time's first ten characters), which orders a
    malformed time as its whole text does; the ranking goes by the parsed day,
    and sums again over a day's texts. ``n_rows`` keeps presence exact (a day
    whose values are all NULL still counts as present). ``keys``: extra columns
    that the time determines (e.g. a ``yyyy-MM`` partition column), carried
    through so the result can be partitioned like its source.
    """
    rows, groups = _by_day(df, ts_col, id_col, value_col, day_col, keys)
    return _sum_days(rows, groups)


def dealt_day_totals(
    df: DataFrame,
    ts_col: str,
    id_col: str,
    value_col: str,
    day_col: str = "day",
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """``day_totals`` in tasks of bounded memory, for stored counts of any size (``dealt_by_group``
    measures them at once)."""
    rows, groups = _by_day(df, ts_col, id_col, value_col, day_col, keys)
    return _sum_days(dealt_by_group(rows, groups), groups)


def _by_day(df, ts_col, id_col, value_col, day_col, keys) -> tuple[DataFrame, list[str]]:
    day, text = day_of(df, ts_col).alias(day_col), day_text_of(df, ts_col).alias("day_text")
    rows = df.select(day, text, F.col(id_col), *keys, F.col(value_col).alias("__value"))
    return rows, [day_col, "day_text", id_col, *keys]


def _sum_days(rows: DataFrame, groups: list[str]) -> DataFrame:
    return rows.groupBy(*groups).agg(F.sum("__value").alias("total"), F.count(F.lit(1)).alias("n_rows"))


def dealt_by_group(
    df: DataFrame, keys: list[str], rows_per_task: int | None = None, summed: bool = False
) -> DataFrame:
    """``df`` dealt out by ``keys`` to tasks of about ``rows_per_task`` rows, for a ``groupBy`` of them.

    A task that groups holds its groups in memory, and Spark sizes tasks by compressed
    bytes and cores. Where groups are nearly as many as rows, a sum per task before the
    shuffle saves nothing, so the rows are dealt out to as many tasks as they need; the
    ``groupBy`` that follows takes this shuffle for its own. ``df`` is returned as it is when
    one task can take its rows, or when its groups hold ``ROWS_PER_GROUP`` rows or more on
    average: summing per task then leaves few to shuffle. ``summed``: the rows are known to be
    sums already, one or few per group, and are only counted. This runs a job at once.
    """
    rows_per_task = rows_per_task or ROWS_PER_TASK
    if summed:
        n_rows, n_groups = df.count(), None
    else:
        group = F.approx_count_distinct(F.xxhash64(*keys))
        n_rows, n_groups = df.agg(F.count(F.lit(1)), group).first()
    if n_rows <= rows_per_task or (n_groups is not None and n_rows >= ROWS_PER_GROUP * n_groups):
        return df
    return df.repartition(math.ceil(n_rows / rows_per_task), *keys)


def dealt_in_order(df: DataFrame, keys: list[str], rows_per_task: int | None = None) -> DataFrame:
    """``df`` dealt out by ranges of ``keys``, in their order, to tasks of about ``rows_per_task`` rows
    whatever Spark's sizes of tasks; a ``groupBy`` of the keys takes this shuffle for its own.
    This runs jobs at once: the rows are counted, and the ranges are found."""
    n_rows = df.count()
    return df.repartitionByRange(max(1, math.ceil(n_rows / (rows_per_task or ROWS_PER_TASK))), *keys)


def present_in_both(
    df: DataFrame,
    ts_col: str,
    base: tuple[str, str],
    current: tuple[str, str],
    id_col: str,
    value_col: str,
    base_out: str,
    current_out: str,
    month_col: str | None = None,
    rows_col: str | None = None,
) -> DataFrame:
    """Totals of two periods per key, keeping keys present in *both* periods,
    with their row counts ``__n_base`` / ``__n_current``.

    Same rows as ``period_total(base) JOIN period_total(current) USING (id)``
    (inner join), computed with a single scan and a single aggregation:
    rows of either period are read once, summed conditionally, and a key
    survives when it has at least one row in each period. Presence is
    decided by row counts, not sums, so a key whose values are all NULL in a
    period is kept with a NULL total exactly as the join keeps it. NULL keys
    never match in the join and are dropped here too. Overlapping periods
    count a row in both. ``month_col`` (a ``yyyy-MM`` partition column
    derived from ``ts_col``) adds partition pruning for the two periods.

    ``rows_col``: the input is already aggregated (e.g. ``day_totals``) and
    this column holds how many raw rows each input row stands for."""
    in_base = in_period(df, ts_col, *base)
    in_current = in_period(df, ts_col, *current)
    value = F.col(value_col)
    if rows_col:
        weight = F.col(rows_col)
        n_base = F.coalesce(F.sum(F.when(in_base, weight)), F.lit(0))
        n_current = F.coalesce(F.sum(F.when(in_current, weight)), F.lit(0))
    else:
        n_base = F.count(F.when(in_base, F.lit(1)))
        n_current = F.count(F.when(in_current, F.lit(1)))
    cond = (in_base | in_current) & F.col(id_col).isNotNull()
    if month_col:
        cond = (months_touching(month_col, *base) | months_touching(month_col, *current)) & cond
    return (
        df.filter(cond)
        .groupBy(id_col)
        .agg(
            F.sum(F.when(in_base, value)).alias(base_out),
            F.sum(F.when(in_current, value)).alias(current_out),
            n_base.alias("__n_base"),
            n_current.alias("__n_current"),
        )
        .filter((F.col("__n_base") > 0) & (F.col("__n_current") > 0))
    )
