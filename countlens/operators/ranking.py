"""Top-N keys per period (sum, then ``row_number`` within the period)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countlens.operators.ordering import placed, written


def rank_within(
    totals: DataFrame,
    period_col: str,
    id_col: str,
    value_col: str,
    n: int,
    rank_col: str = "rank",
) -> DataFrame:
    """Keep the ``n`` largest ``value_col`` rows of each period, numbered 1..n.

    Ties on the value are broken by ``id_col`` ascending so the result is
    deterministic. The ``row_number() <= n`` filter lets Catalyst insert a
    partial ``WindowGroupLimit`` before the shuffle on ``period_col``: every
    task forwards at most ``n`` rows per period, so a period holding a large
    share of the data never lands whole in one task. Catalyst does so only up
    to ``spark.sql.optimizer.windowGroupLimitThreshold``; beyond it, rows are
    ranked by a range sort (``rank_by_range``), which writes as it is called.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    limit = int(totals.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        return rank_by_range(totals, period_col, id_col, value_col, n, rank_col)
    order = (F.col(value_col).desc_nulls_last(), F.col(id_col).asc_nulls_first())
    w = Window.partitionBy(period_col).orderBy(*order)
    return totals.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def within_reach(totals: DataFrame, period_col: str, id_col: str, value_col: str, n: int) -> DataFrame:
    """``totals`` (one row per period and id) without rows that cannot be among the ``n`` largest of their period.

    Ids are dealt to ``n`` groups by their hash: the largest rows of a period's groups are ``n`` rows, so none below the
    smallest of them is ranked. What is left is ``n`` groups' worth of rows near the top, so that ranking need not sort all
    rows of a task. A period keeps all its rows if a group of it has no value. The bounds are broadcast, one row per
    period: for a small ``n`` and periods such as days, of which there are thousands at most.
    """
    group = F.pmod(F.xxhash64(id_col), F.lit(n)).alias("__group")
    tops = totals.groupBy(period_col, group).agg(F.max(value_col).alias("__top"))
    bounds = tops.groupBy(F.col(period_col).alias("__period")).agg(F.count("__top").alias("__n"), F.min("__top").alias("__bound"))
    bounds = bounds.filter(F.col("__n") == n).drop("__n")
    bounded = totals.join(F.broadcast(bounds), F.col(period_col).eqNullSafe(F.col("__period")), "left")
    reached = F.col("__bound").isNull() | F.coalesce(F.col(value_col) >= F.col("__bound"), F.lit(False))
    return bounded.filter(reached).select(*totals.columns)


def rank_by_range(
    totals: DataFrame,
    period_col: str,
    id_col: str,
    value_col: str,
    n: int | None = None,
    rank_col: str = "rank",
) -> DataFrame:
    """``rank_within`` for any ``n`` (None: all rows), with no task that holds a period.

    Totals are written once, sorted by ranges of (period, value, id) and
    written again; a rank is a row's place in its partition plus the sizes of
    the period's earlier partitions. A period that holds all rows is spread
    over all partitions. Null values come last, null ids first, and a null
    period is a period.
    """
    if n is not None and n < 1:
        raise ValueError("n must be at least 1")
    order = (F.col(value_col).desc_nulls_last(), F.col(id_col).asc_nulls_first())
    ranked = placed(written(totals, "totals"), [period_col], order, "__place", "__of")
    kept = ranked if n is None else ranked.filter(F.col("__place") < n)
    place = (F.col("__place") + 1).cast("long")
    return kept.withColumn(rank_col, place if n is None or n >= 1 << 31 else place.cast("int")).drop("__place", "__of")


def top_n_by_period(
    df: DataFrame,
    period_col: str,
    id_col: str,
    value_col: str,
    n: int,
    out: str,
    rank_col: str = "rank",
) -> DataFrame:
    """Sum ``value_col`` per (period, id) and keep the top ``n`` ids per period.

    Output columns: ``period_col, id_col, out, rank_col``. A NULL period is
    a group of its own, like any other period.
    """
    totals = df.groupBy(period_col, id_col).agg(F.sum(value_col).alias(out))
    return rank_within(totals, period_col, id_col, out, n, rank_col)
