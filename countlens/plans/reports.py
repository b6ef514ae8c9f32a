"""The four count reports as lazy DataFrame plans.

Every function takes the counts and the sensor dimension as DataFrames plus
the column names to use (defaults are the stored table's names), and
returns an unexecuted DataFrame. Output columns are fixed report names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countlens.functions.change import difference, percent_of
from countlens.functions.datetime import day_of, month_of_day_text
from countlens.operators.enrich import label_join
from countlens.operators.periods import present_in_both
from countlens.operators.ranking import rank_within, top_n_by_period

# The comparison years of the two change reports
# (each year runs 1 November to 1 November, end exclusive).
DECLINE_BASE_YEAR = ("2018-11-01", "2019-11-01")
DECLINE_CURRENT_YEAR = ("2021-11-01", "2022-11-01")
PREVIOUS_YEAR = ("2020-11-01", "2021-11-01")
LAST_YEAR = ("2021-11-01", "2022-11-01")


def _cast(c, type_name: str | None):
    return c if type_name is None else c.cast(type_name)


def top_n_by_day(
    counts: DataFrame,
    dim: DataFrame,
    n: int = 10,
    ts_col: str = "date_time",
    id_col: str = "sensor_id",
    value_col: str = "hourly_count",
    dim_key: str = "location_id",
    label_col: str = "sensor_description",
    count_type: str = "bigint",
    id_type: str | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Top ``n`` sensors per calendar day by summed count, labelled.

    Columns: ``date`` (``yyyy-MM-dd`` text), ``rank`` int, ``sensor_id``,
    ``location_name``, ``daily_count``. Plan: pruned scan -> partial/final
    sum per (day, sensor) -> partial WindowGroupLimit -> shuffle by day ->
    row_number <= n -> left join to the dimension.

    ``ordered=True`` adds a global sort (day descending, rank ascending),
    which costs a sampling pass and a range shuffle; by default rows come
    unordered, as the original's sort placed before the label join is
    dropped by the optimizer anyway.
    """
    src = counts.select(
        day_of(counts, ts_col).alias("__day"),
        F.col(id_col).alias("sensor_id"),
        F.col(value_col).alias("__v"),
    )
    ranked = top_n_by_period(src, "__day", "sensor_id", "__v", n, "__total")
    return _daily_report(
        ranked, dim, dim_key, label_col, count_type, id_type, ordered
    )


def top_n_from_day_totals(
    totals: DataFrame,
    dim: DataFrame,
    n: int = 10,
    day_col: str = "day",
    id_col: str = "sensor_id",
    total_col: str = "total",
    dim_key: str = "location_id",
    label_col: str = "sensor_description",
    count_type: str = "bigint",
    id_type: str | None = None,
    ordered: bool = False,
) -> DataFrame:
    """``top_n_by_day`` from stored day totals (one row per day and sensor,
    e.g. ``operators.periods.day_totals``): no re-aggregation, only the
    ranking. Same columns as ``top_n_by_day``."""
    src = totals.select(
        F.col(day_col).alias("__day"),
        F.col(id_col).alias("sensor_id"),
        F.col(total_col).alias("__total"),
    )
    ranked = rank_within(src, "__day", "sensor_id", "__total", n)
    return _daily_report(
        ranked, dim, dim_key, label_col, count_type, id_type, ordered
    )


def _daily_report(ranked, dim, dim_key, label_col, count_type, id_type, ordered):
    labelled = label_join(
        ranked, dim, "sensor_id", dim_key, label_col, "location_name"
    )
    out = labelled.select(
        F.col("__day").cast("string").alias("date"),
        F.col("rank").cast("int").alias("rank"),
        _cast(F.col("sensor_id"), id_type).alias("sensor_id"),
        F.col("location_name"),
        F.col("__total").cast(count_type).alias("daily_count"),
    )
    return out.orderBy(F.col("date").desc(), F.col("rank").asc()) if ordered else out


def top_n_by_month(
    daily_report: DataFrame,
    dim: DataFrame,
    n: int = 10,
    dim_key: str = "location_id",
    label_col: str = "sensor_description",
    count_type: str = "bigint",
    ordered: bool = False,
) -> DataFrame:
    """Top ``n`` sensors per month, rolled up from the *daily top-n report*.

    Like the original job, the source is the daily report, so a sensor's
    month total only includes the days on which it made the daily top n.
    Columns: ``year_month``, ``rank``, ``sensor_id``, ``location_name``,
    ``monthly_count``.
    """
    src = daily_report.select(
        month_of_day_text("date").alias("year_month"),
        F.col("sensor_id"),
        F.col("daily_count"),
    )
    ranked = top_n_by_period(src, "year_month", "sensor_id", "daily_count", n, "__total")
    labelled = label_join(
        ranked, dim, "sensor_id", dim_key, label_col, "location_name"
    )
    out = labelled.select(
        F.col("year_month").cast("string").alias("year_month"),
        F.col("rank").cast("int").alias("rank"),
        F.col("sensor_id"),
        F.col("location_name"),
        F.col("__total").cast(count_type).alias("monthly_count"),
    )
    return out.orderBy(F.col("year_month").desc(), F.col("rank").asc()) if ordered else out


def _change_report(
    counts: DataFrame,
    dim: DataFrame,
    direction: str,
    base: tuple[str, str],
    current: tuple[str, str],
    names: tuple[str, str, str, str],
    ts_col: str,
    id_col: str,
    value_col: str,
    dim_key: str,
    label_col: str,
    count_type: str,
    ordered: bool,
    month_col: str | None = None,
    rows_col: str | None = None,
) -> DataFrame:
    """Totals of two periods per key, their difference and percent of the *base*
    (earlier) total; a zero base gives NULL, keys missing from either period are
    dropped. Largest percent first when ordered, equal percents by sensor."""
    base_out, current_out, change_out, percent_out = names
    totals = present_in_both(
        counts, ts_col, base, current, id_col, value_col, "__base", "__current", month_col,
        rows_col,
    )
    labelled = label_join(
        totals, dim, id_col, dim_key, label_col, "location_name"
    )
    b = F.col("__base").cast(count_type)
    c = F.col("__current").cast(count_type)
    change = difference(b, c) if direction == "decline" else difference(c, b)
    out = labelled.select(
        F.col(id_col).alias("sensor_id"),
        F.col("location_name"),
        b.alias(base_out),
        c.alias(current_out),
        change.alias(change_out),
        percent_of(change, b).alias(percent_out),
    )
    return out.orderBy(F.col(percent_out).desc_nulls_last(), F.col("sensor_id")) if ordered else out


def decline_report(
    counts: DataFrame,
    dim: DataFrame,
    base: tuple[str, str] = DECLINE_BASE_YEAR,
    current: tuple[str, str] = DECLINE_CURRENT_YEAR,
    ts_col: str = "date_time",
    id_col: str = "sensor_id",
    value_col: str = "hourly_count",
    dim_key: str = "location_id",
    label_col: str = "sensor_description",
    count_type: str = "bigint",
    ordered: bool = True,
    names: tuple[str, str, str, str] = ("count_2019", "count_2022", "decline", "decline_percent"),
    month_col: str | None = None,
    rows_col: str | None = None,
) -> DataFrame:
    """Per sensor: base-year and current-year totals, ``decline = base - current``
    and ``decline_percent = decline / base * 100``, largest percent first.

    ``month_col``: a ``yyyy-MM`` partition column of ``counts`` derived from
    ``ts_col``; only the months of the two years are then read.
    ``rows_col``: ``counts`` is pre-aggregated (e.g. day totals) and this
    column holds the raw row count behind each row."""
    return _change_report(
        counts, dim, "decline", base, current, names, ts_col, id_col, value_col,
        dim_key, label_col, count_type, ordered, month_col, rows_col,
    )


def growth_report(
    counts: DataFrame,
    dim: DataFrame,
    previous: tuple[str, str] = PREVIOUS_YEAR,
    last: tuple[str, str] = LAST_YEAR,
    ts_col: str = "date_time",
    id_col: str = "sensor_id",
    value_col: str = "hourly_count",
    dim_key: str = "location_id",
    label_col: str = "sensor_description",
    count_type: str = "bigint",
    ordered: bool = True,
    names: tuple[str, str, str, str] = (
        "count_previous_year", "count_last_year", "growth", "growth_percent",
    ),
    month_col: str | None = None,
    rows_col: str | None = None,
) -> DataFrame:
    """Per sensor: previous-year and last-year totals, ``growth = last - previous``
    and ``growth_percent = growth / previous * 100``, largest percent first.

    ``month_col``, ``rows_col``: as in ``decline_report``."""
    return _change_report(
        counts, dim, "growth", previous, last, names, ts_col, id_col, value_col,
        dim_key, label_col, count_type, ordered, month_col, rows_col,
    )
