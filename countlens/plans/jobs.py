"""End-to-end jobs: land the raw tables, build the four reports, run data tests.

Each report reads *stored* tables and is written as a new table version,
so every report's lineage starts at a Parquet scan (a lost executor only
recomputes the short scan -> aggregate -> rank -> join chain), and the
monthly report reads the daily report as written, as the original does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from countlens.operators.checks import (
    failing_rows,
    gate,
    run_checks,
    sensor_counts_checks,
    sensor_reference_checks,
    top_n_by_day_checks,
)
from countlens.plans.reports import (
    LAST_YEAR,
    DECLINE_BASE_YEAR,
    DECLINE_CURRENT_YEAR,
    PREVIOUS_YEAR,
    decline_report,
    growth_report,
    top_n_by_day,
    top_n_by_month,
    top_n_from_day_totals,
)
from countlens.functions.datetime import is_day, month_of_day_text
from countlens.operators.periods import dealt_by_group, dealt_day_totals
from countlens.schemas import CHECK_FAILURES_BY_MONTH, FAILING_ROWS_BY_MONTH, FILE_KEY, MONTH_COL
from countlens.schemas import DUPLICATE_IDS_BY_MONTH as DUPLICATE_IDS_SCHEMA
from countlens.schemas import SENSOR_COUNTS as SENSOR_COUNTS_SCHEMA
from countlens.schemas import SENSOR_DAY_TOTALS as DAY_TOTALS_SCHEMA
from countlens.session import scratch_path
from countlens.sources.files import (
    counts_from_raw,
    read_counts_csv,
    UNPARSED_PREFIX,
    read_raw_counts_csv,
    read_reference_json,
    with_month,
)
from countlens.sources.tables import (
    empty_partitions,
    listed_partitions,
    overwrite_partitions,
    overwrite_path,
    overwrite_table,
    publish_table,
    register_table,
)

# Table names of the data mart.
SENSOR_COUNTS = "sensor_counts"
SENSOR_REFERENCE = "sensor_reference_data"
TOP_BY_DAY = "report_top_10_locations_by_day"
TOP_BY_MONTH = "report_top_10_locations_by_month"
DECLINES = "report_location_declines_due_to_lockdown"
GROWTH = "report_most_growth_last_year"
DAY_TOTALS = "sensor_day_totals"
CHECK_FAILURES = "sensor_counts_check_failures"
DUPLICATE_IDS = "sensor_counts_duplicate_ids"
FAILING_ROWS = "sensor_counts_failing_rows"

def _whole_days(*periods) -> bool:
    return all(is_day(bound) for period in periods for bound in period)


def ingest_counts(
    spark: SparkSession,
    csv_path: str,
    root: str,
    raw_db: str = "raw",
    on_bad: str = "fail",
    sort_by_time: bool = True,
    mixed_headers: bool = False,
    id_type: str = "bigint",
) -> str:
    """Raw count CSV -> typed ``raw_db.sensor_counts``.

    ``sort_by_time`` sorts rows by ``date_time`` *within* each output file (a
    per-task sort, no shuffle), so Parquet row-group min/max statistics let
    the period filters of the change reports skip most of the table.
    """
    counts = read_counts_csv(spark, csv_path, on_bad, mixed_headers=mixed_headers, id_type=id_type)
    if sort_by_time:
        counts = counts.sortWithinPartitions("date_time")
    return publish_table(counts, f"{raw_db}.{SENSOR_COUNTS}", root)


def ingest_counts_by_month(
    spark: SparkSession,
    csv_path: str,
    location: str,
    raw_db: str = "raw",
    on_bad: str = "fail",
    mixed_headers: bool = False,
) -> str:
    """Raw count CSV -> ``raw_db.sensor_counts`` partitioned by ``year_month``.

    The layout for large, growing count data: each run rewrites only the
    months present in the landed files, and the change reports given
    ``month_col="year_month"`` read only the months of their two periods.
    Landing and merging are separate steps for jobs that derive more tables
    from the same batch: ``land_counts`` and ``merge_counts``.
    """
    merge_counts(spark, land_counts(spark, csv_path, on_bad, mixed_headers), location, raw_db)
    return f"{raw_db}.{SENSOR_COUNTS}"


def land_counts(spark: SparkSession, csv_path: str, on_bad: str = "fail", mixed_headers: bool = False) -> DataFrame:
    """A landed count batch, parsed once and stored (``read_landed_counts``)."""
    path = scratch_path(spark, "landed-counts")
    overwrite_path(read_landed_counts(spark, csv_path, on_bad, mixed_headers, keep_key=True), path)
    return spark.read.parquet(path)


def merge_counts(spark: SparkSession, batch: DataFrame, location: str, raw_db: str = "raw") -> DataFrame:
    """Merge a landed batch into ``raw_db.sensor_counts``; returns the stored rows of its months.

    A row of the batch replaces the stored rows of its month that have its
    ``id``; all other stored rows stay, so a late or partial batch removes
    nothing that it does not replace. Rows without an id are replaced by equal
    rows. Rows whose time does not parse are kept by source file, and landing a
    file again replaces that file's, also by none (``corrected_files`` names the
    partitions that so lose all rows, for the tables derived from the counts). A row
    whose corrected time lies in another month does not remove the old one:
    ``unique(id)`` reports it. ``plans.batches.CountMart`` keeps an index of ids and
    files and replaces rows wherever they are.
    """
    name = f"{raw_db}.{SENSOR_COUNTS}"
    schema = StructType([*SENSOR_COUNTS_SCHEMA.fields, StructField(MONTH_COL, StringType(), True)])
    known = spark.catalog.tableExists(name)
    register_table(spark, name, schema, location, partition_by=[MONTH_COL])
    rows = batch.select(*schema.names)
    if known:
        row_key = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("row "), F.xxhash64(*schema.names)))
        replaced = rows.select(MONTH_COL, row_key.alias("__key")).distinct()
        stored = stored_months(spark, name, batch).filter(~F.col(MONTH_COL).startswith(UNPARSED_PREFIX))
        stored = stored.withColumn("__key", row_key).join(replaced, [MONTH_COL, "__key"], "left_anti")
        rows = rows.unionByName(stored.select(*schema.names))
    gone = corrected_files(spark, batch, raw_db) if known else []
    overwrite_partitions(rows, name, sort_by=("date_time",))
    if gone:
        empty_partitions(spark, name, gone)
    return stored_months(spark, name, batch)


def corrected_files(spark: SparkSession, batch: DataFrame, raw_db: str = "raw") -> list[str]:
    """Partitions of unparsed rows that files of a landed batch had and no longer have."""
    if FILE_KEY not in batch.columns:
        return []
    rows = batch.select(MONTH_COL, F.concat(F.lit(UNPARSED_PREFIX), F.col(FILE_KEY)).alias("key"))
    own = {r["key"] for r in rows.select("key").distinct().collect()}  # as many as the batch has files
    filled = {r[0] for r in rows.select(MONTH_COL).distinct().collect()}
    return sorted((own - filled) & listed_partitions(spark, f"{raw_db}.{SENSOR_COUNTS}"))


def stored_months(spark: SparkSession, name: str, batch: DataFrame) -> DataFrame:
    """The stored rows of the months of a batch; other partitions are not opened, and the rows are
    not shuffled: the months of a batch (and its files of unparsed rows) are few and broadcast."""
    return spark.table(name).join(F.broadcast(batch.select(MONTH_COL).distinct()), MONTH_COL, "left_semi")


def refresh_day_totals(
    spark: SparkSession,
    counts: DataFrame,
    location: str,
    report_db: str = "report",
    full: bool = False,
) -> str:
    """Maintain ``report_db.sensor_day_totals`` partitioned by ``year_month``.

    ``counts`` holds stored counts with a ``year_month`` column. Incremental
    (default): pass what ``merge_counts`` returns, all stored rows of the
    months just merged; only those partitions are rewritten. Re-running after
    a failure rewrites the same months. ``full=True``: pass the whole stored
    counts table; every partition is replaced.

    The reports then read the day totals (a 24th of hourly rows) instead of
    the raw counts; see ``build_reports(day_totals_table=...)``.
    """
    name = f"{report_db}.{DAY_TOTALS}"
    totals = dealt_day_totals(counts, "date_time", "sensor_id", "hourly_count", keys=(MONTH_COL,))
    register_table(spark, name, DAY_TOTALS_SCHEMA, location, partition_by=[MONTH_COL])
    if full:
        overwrite_table(totals, name)
    else:
        overwrite_partitions(totals, name)
    return name


def refresh_check_failures(
    spark: SparkSession,
    counts: DataFrame,
    location: str,
    report_db: str = "report",
    full: bool = False,
) -> str:
    """Maintain ``report_db.sensor_counts_check_failures``: the failures of
    every row-level check of ``sensor_counts`` per ``year_month``.

    Same contract as ``refresh_day_totals``: pass the stored rows of the months
    just merged and only those months are recounted (one grouped aggregate,
    dynamic partition overwrite), or the whole stored table with ``full=True``. Row-check failures add up over
    months, so ``data_tests(check_failures_table=...)`` gets the table's
    counts by summing, without reading the stored counts for them.
    """
    name = f"{report_db}.{CHECK_FAILURES}"
    row_checks = [ch for ch in sensor_counts_checks() if ch.kind == "row"]
    failures = run_checks(counts, row_checks, SENSOR_COUNTS, by=(MONTH_COL,))
    register_table(spark, name, CHECK_FAILURES_BY_MONTH, location, partition_by=[MONTH_COL])
    if full:
        overwrite_table(failures, name)
    else:
        overwrite_partitions(failures, name)
    return name


def refresh_failing_rows(
    spark: SparkSession,
    counts: DataFrame,
    location: str,
    report_db: str = "report",
    full: bool = False,
    partitions: list[str] | None = None,
    empty: list[str] = (),
    failing: set[str] | None = None,
) -> str:
    """Maintain ``report_db.sensor_counts_failing_rows``: every stored row that fails a row-level
    check, once per check, by month.

    Same contract as ``refresh_day_totals``. ``partitions`` names the months that ``counts``
    holds: those of them without a failing row are emptied, as are those in ``empty``.
    ``failing``: which of them have one, where that is known (``refresh_check_failures``);
    only those are then read, once, and each task writes the months of the files that it reads.
    """
    name = f"{report_db}.{FAILING_ROWS}"
    row_checks = [ch for ch in sensor_counts_checks() if ch.kind == "row"]
    register_table(spark, name, FAILING_ROWS_BY_MONTH, location, partition_by=[MONTH_COL])
    if partitions is not None and failing is not None and not full:
        counts = counts.filter(F.col(MONTH_COL).isin(sorted(failing)))
    rows = failing_rows(counts, row_checks, [*SENSOR_COUNTS_SCHEMA.names, MONTH_COL])
    if full:
        overwrite_table(rows, name)
        return name
    if partitions is not None and failing is not None:
        named = {*partitions, *empty}
        gone = sorted((named - failing) & listed_partitions(spark, name))
        overwrite_partitions(rows, name, (), sorted(failing & named), gone, regroup=False)
        return name
    path = scratch_path(spark, "failing-rows")  # the scan of the counts is not repeated
    overwrite_path(rows, path)
    rows = spark.read.parquet(path)
    if partitions is None:
        overwrite_partitions(rows, name)
        return name
    found = {r[0] for r in rows.select(MONTH_COL).distinct().collect()}
    overwrite_partitions(rows, name, ("column_name",), partitions, sorted({*partitions, *empty} - found))
    return name


def refresh_duplicate_ids(
    spark: SparkSession, counts: DataFrame, location: str, raw_db: str = "raw", report_db: str = "report"
) -> str:
    """Maintain ``report_db.sensor_counts_duplicate_ids``: per month, the ids of its rows that
    stand more than once in the stored counts.

    Pass the stored rows of the months just merged. Their ids are looked up
    among the stored ids of their range only (ids grow over time, so file
    statistics leave out most of the table). A NULL row marks each month as
    looked at, so a month whose duplicates went away is written anew.
    """
    name, stored = f"{report_db}.{DUPLICATE_IDS}", spark.table(f"{raw_db}.{SENSOR_COUNTS}")
    register_table(spark, name, DUPLICATE_IDS_SCHEMA, location, partition_by=[MONTH_COL])
    ids = counts.filter("id is not null").select("id", MONTH_COL)
    low, high = ids.agg(F.min("id"), F.max("id")).first()
    again = stored.filter(F.col("id").between(low, high)).groupBy("id").agg(F.count(F.lit(1)).alias("__n"))
    again = ids.join(again.filter("__n > 1").select("id"), "id", "left_semi").distinct()
    marks = counts.select(F.lit(None).cast("bigint").alias("id"), MONTH_COL).distinct()
    overwrite_partitions(again.unionByName(marks), name, sort_by=("id",))
    return name


def read_landed_counts(
    spark: SparkSession,
    csv_path: str,
    on_bad: str = "fail",
    mixed_headers: bool = False,
    keep_key: bool = False,
    by_folder: bool = False,
) -> DataFrame:
    """A landed count batch, typed, with the ``year_month`` partition column (and ``file_key``, of
    each row's file or of its folder)."""
    raw = read_raw_counts_csv(spark, csv_path, mixed_headers)
    file = F.col("_metadata.file_path")
    if by_folder:
        # Its bytes up to the last "/", taken by length: a pattern would search the whole path of every row.
        folder = F.octet_length(file) - F.octet_length(F.substring_index(file, "/", -1)) - 1
        file = F.substring(file.cast("binary"), F.lit(1), folder)
    typed = counts_from_raw(raw, on_bad, extra=(file.alias("__file"),))
    return with_month(typed, keep_key=keep_key)


def ingest_reference(
    spark: SparkSession,
    json_path: str,
    root: str,
    raw_db: str = "raw",
    multi_line: bool = False,
    on_bad: str = "fail",
) -> str:
    """Sensor JSON (Lines, or an array with ``multi_line``) -> ``raw_db.sensor_reference_data``
    with the declared schema."""
    df = read_reference_json(spark, json_path, multi_line=multi_line, on_bad=on_bad)
    return publish_table(df, f"{raw_db}.{SENSOR_REFERENCE}", root)


def _one_row_per_day(days: DataFrame) -> DataFrame:
    """Day totals with one row per (day, sensor), summed over the texts that stand for a day."""
    days = dealt_by_group(days, ["day", "sensor_id"], summed=True)
    return days.groupBy("day", "sensor_id").agg(F.sum("total").alias("total"), F.sum("n_rows").alias("n_rows"))


def _refuse_to_replace_maintained_totals(spark: SparkSession, name: str) -> None:
    """The one-scan path publishes ``name`` as a new version; a month-partitioned
    table kept by ``refresh_day_totals`` must not be repointed by it."""
    if spark.catalog.tableExists(name) and any(
        getattr(c, "isPartition", False) for c in spark.catalog.listColumns(name)
    ):
        raise ValueError(
            f"{name} is maintained by refresh_day_totals; pass day_totals_table={name!r}"
        )


def build_reports(
    spark: SparkSession,
    root: str,
    raw_db: str = "raw",
    report_db: str = "report",
    n: int = 10,
    decline_periods: tuple = (DECLINE_BASE_YEAR, DECLINE_CURRENT_YEAR),
    growth_periods: tuple = (PREVIOUS_YEAR, LAST_YEAR),
    month_col: str | None = None,
    one_scan: bool = True,
    day_totals_table: str | None = None,
    ordered: bool = False,
    count_type: str = "bigint",
) -> dict[str, str]:
    """Write the four reports from the stored raw tables; returns locations.

    ``day_totals_table``: a day totals table kept up to date with
    ``refresh_day_totals`` (the layout for large, growing counts). Every
    report is then computed from it and no raw count is read; the change
    reports read only the month partitions of their periods. Needs
    whole-day period bounds.

    ``one_scan`` (default): when every period bound is a whole day, the raw
    counts are read once into stored day totals (``sensor_day_totals``:
    day, sensor, total, raw row count), and the daily ranking and both
    change reports are computed from that much smaller table. A change
    period total is then the sum of its day totals, by the text of the
    stored time, with presence taken from the raw row counts, so results
    equal the per-report scans, malformed times included.
    Otherwise each report scans the raw counts; pass
    ``month_col="year_month"`` when they were landed with
    ``ingest_counts_by_month`` so those scans prune partitions.

    ``ordered``: the rankings come sorted, period descending and rank
    ascending, and the change reports by percent (as always) and sensor.
    ``count_type="int"``: the counts are written in the narrow type."""
    counts = spark.table(f"{raw_db}.{SENSOR_COUNTS}")
    dim = spark.table(f"{raw_db}.{SENSOR_REFERENCE}")
    form = dict(n=n, ordered=ordered, count_type=count_type)
    out = {}
    if day_totals_table:
        if not _whole_days(*decline_periods, *growth_periods):
            raise ValueError("reports from day totals need whole-day period bounds")
        days = spark.table(day_totals_table)
        daily_plan = top_n_from_day_totals(_one_row_per_day(days), dim, **form)
        change_src = dict(
            counts=days, ts_col="day_text", value_col="total", rows_col="n_rows",
            month_col=MONTH_COL if MONTH_COL in days.columns else None,
        )
    elif one_scan and _whole_days(*decline_periods, *growth_periods):
        _refuse_to_replace_maintained_totals(spark, f"{report_db}.{DAY_TOTALS}")
        # One scan of the raw counts: day totals are stored (a lineage cut)
        # and serve the daily ranking and both change reports.
        out[DAY_TOTALS] = publish_table(
            dealt_day_totals(counts, "date_time", "sensor_id", "hourly_count"),
            f"{report_db}.{DAY_TOTALS}",
            root,
        )
        days = spark.table(f"{report_db}.{DAY_TOTALS}")
        daily_plan = top_n_from_day_totals(_one_row_per_day(days), dim, **form)
        change_src = dict(counts=days, ts_col="day_text", value_col="total", rows_col="n_rows")
    else:
        daily_plan = top_n_by_day(counts, dim, **form)
        change_src = dict(counts=counts, month_col=month_col)
    out[TOP_BY_DAY] = publish_table(daily_plan, f"{report_db}.{TOP_BY_DAY}", root)
    daily = spark.table(f"{report_db}.{TOP_BY_DAY}")
    out[TOP_BY_MONTH] = publish_table(
        top_n_by_month(daily, dim, **form), f"{report_db}.{TOP_BY_MONTH}", root
    )
    out[DECLINES] = publish_table(
        decline_report(dim=dim, base=decline_periods[0], current=decline_periods[1], count_type=count_type, **change_src),
        f"{report_db}.{DECLINES}",
        root,
    )
    out[GROWTH] = publish_table(
        growth_report(dim=dim, previous=growth_periods[0], last=growth_periods[1], count_type=count_type, **change_src),
        f"{report_db}.{GROWTH}",
        root,
    )
    return out


def data_tests(
    spark: SparkSession,
    raw_db: str = "raw",
    report_db: str = "report",
    n: int = 10,
    check_failures_table: str | None = None,
    duplicate_ids_table: str | None = None,
) -> DataFrame:
    """All checks of the three tested tables as one result DataFrame.

    ``check_failures_table``: per-month failures kept by
    ``refresh_check_failures``; the row checks of the counts are then sums
    over it, and only ``unique(id)``, which does not add up over months,
    reads the stored counts (their ``id`` column alone), or, with
    ``duplicate_ids_table`` (``refresh_duplicate_ids``), no stored count at all.
    """
    counts = spark.table(f"{raw_db}.{SENSOR_COUNTS}")
    if check_failures_table:
        counts_part = _checks_from_failures(spark, counts, check_failures_table, duplicate_ids_table)
    else:
        counts_part = run_checks(counts, sensor_counts_checks(), SENSOR_COUNTS)
    parts = [
        counts_part,
        run_checks(
            spark.table(f"{raw_db}.{SENSOR_REFERENCE}"), sensor_reference_checks(), SENSOR_REFERENCE
        ),
        run_checks(spark.table(f"{report_db}.{TOP_BY_DAY}"), top_n_by_day_checks(n), TOP_BY_DAY),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def require_data_tests(results: DataFrame) -> None:
    """Stop a pipeline on failed data tests: raises ``ChecksFailed`` with their names."""
    gate(results)


def _checks_from_failures(
    spark: SparkSession, counts: DataFrame, table: str, duplicates: str | None = None
) -> DataFrame:
    checks = sensor_counts_checks()
    keys = ["table_name", "column_name", "check_name"]
    # A zero row per check (a literal list, no data) keeps every check in
    # the result even before any month has been counted.
    listed = spark.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(SENSOR_COUNTS).alias("table_name"),
                        F.lit(ch.column).alias("column_name"),
                        F.lit(ch.name).alias("check_name"),
                        F.lit(0).cast("bigint").alias("failures"),
                    )
                    for ch in checks
                    if ch.kind == "row"
                ]
            )
        )
    )
    rows = (
        spark.table(table)
        .select(*keys, "failures")
        .unionByName(listed)
        .groupBy(*keys)
        .agg(F.sum("failures").cast("bigint").alias("failures"))
    )
    unique_checks = [ch for ch in checks if ch.kind == "unique"]
    if duplicates:
        twice = spark.table(duplicates).filter("id is not null").select("id").distinct()
        found = twice.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(SENSOR_COUNTS).alias("table_name"),
            F.lit("id").alias("column_name"),
            F.lit("unique").alias("check_name"),
            "failures",
        )
        return found.unionByName(rows)
    return run_checks(counts, unique_checks, SENSOR_COUNTS).unionByName(rows)
