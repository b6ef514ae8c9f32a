"""The library's operators run over the shared TPC-H-style test tables.

The test tables carry no sensor data, so each query maps columns:

    counts.date_time    -> lineitem.l_shipdate   (or events.ts)
    counts.sensor_id    -> lineitem.l_suppkey    (or events.user_id)
    counts.hourly_count -> lineitem.l_quantity   (or events.value in cents)
    dim.location_id     -> supplier.s_suppkey    (or customer.c_custkey)
    dim.sensor_description -> supplier.s_name    (or customer.c_name)

Every query reads whole tables (no sampling, id subsets or row caps). Each
has an independent SQL formulation in ``ORACLE_SQL`` that DuckDB runs on
the same Parquet files; column names and types match.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countlens import schemas
from countlens.functions.datetime import (
    DATE_FORMAT,
    ISO_LOCAL_FORMAT,
    RAW_COUNT_TIME_FORMAT,
    RAW_COUNT_TIME_FORMAT_PADDED,
    format_iso,
    parse_local_time,
    session_zone_is_fixed,
)
from countlens.operators import checks as ck
from countlens.operators.enrich import with_label
from countlens.operators.periods import period_total
from countlens.operators.ranking import rank_by_range, top_n_by_period
from countlens.plans import jobs
from countlens.plans.batches import CountMart
from countlens.plans.reports import decline_report, growth_report, top_n_by_day, top_n_by_month
from countlens.session import scratch_path
from countlens.sources.files import read_counts_csv, read_reference_json
from countlens.sources.json_array import read_json_array
from countlens.sources.quarantine import land_with_quarantine
from countlens.sources.tables import (
    overwrite_table,
    passthrough_view,
    preview,
    publish_table,
    register_table,
)
from countlens.sources.versions import expire_versions
from countlens.streaming.ingest import stream_counts_csv

# Periods used on the test tables (l_shipdate spans 1995-2001).
BASE = ("1998-11-01", "1999-11-01")
CURRENT = ("1999-11-01", "2000-11-01")
LAST = ("2000-11-01", "2001-11-01")
HALF_OPEN = ("1996-03-01", "1996-04-01")

LINEITEM_COUNTS = dict(ts_col="l_shipdate", id_col="l_suppkey", value_col="l_quantity")
SUPPLIER_DIM = dict(dim_key="s_suppkey", label_col="s_name")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _lineitem(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


def _supplier(spark, sf_dir):
    return table(spark, sf_dir, "supplier")


def sensor_counts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem in the stored ``sensor_counts`` shape (ISO text ``date_time``).

    ``id = l_orderkey * 8 + l_linenumber`` repeats: the test tables hold several
    lineitems of one key (``unique_id`` tells them apart).
    """
    li = _lineitem(spark, sf_dir)
    labelled = with_label(li, _supplier(spark, sf_dir), "l_suppkey", "s_suppkey", "s_name", "sensor_name")
    return labelled.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        format_iso("l_shipdate", spark).alias("date_time"),
        F.col("l_suppkey").cast("int").alias("sensor_id"),
        F.col("sensor_name"),
        F.col("l_quantity").cast("int").alias("hourly_count"),
    )


def raw_count_time_text(ts: str, spark: SparkSession | None = None) -> F.Column:
    """``timestamp_ntz`` as count-file text (``MMMM dd, yyyy hh:mm:ss a``),
    built from its date and clock fields so that no session time zone can
    shift it (``date_format`` on a timestamp goes through the zone); in a
    fixed-offset session zone ``date_format`` is exact and used."""
    if session_zone_is_fixed(spark):
        return F.date_format(ts, RAW_COUNT_TIME_FORMAT_PADDED)
    c = F.col(ts)
    hour = F.hour(c)
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat(
        F.date_format(F.to_date(c), "MMMM dd, yyyy"),
        F.lit(" "),
        two((hour + 11) % 12 + 1),
        F.lit(":"),
        two(F.minute(c)),
        F.lit(":"),
        two(F.second(c)),
        F.when(hour < 12, F.lit(" AM")).otherwise(F.lit(" PM")),
    )


def raw_count_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as raw count-file rows (text columns, source time format,
    plus an extra ``Year`` column the reader must ignore)."""
    li = _lineitem(spark, sf_dir)
    labelled = with_label(li, _supplier(spark, sf_dir), "l_suppkey", "s_suppkey", "s_name", "sensor_name")
    return labelled.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string").alias("ID"),
        raw_count_time_text("l_shipdate", spark).alias("Date_Time"),
        F.year("l_shipdate").cast("string").alias("Year"),
        F.col("l_suppkey").cast("string").alias("Sensor_ID"),
        F.col("sensor_name").alias("Sensor_Name"),
        F.col("l_quantity").cast("int").cast("string").alias("Hourly_Counts"),
    )


def sensor_reference_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier in the stored ``sensor_reference_data`` shape."""
    sup = _supplier(spark, sf_dir)
    return sup.select(
        F.col("s_suppkey").cast("int").alias("location_id"),
        F.col("s_name").alias("sensor_description"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("sensor_name"),
        F.lit(None).cast("string").alias("installation_date"),
        F.lit(None).cast("string").alias("note"),
        F.lit("Outdoor").alias("location_type"),
        F.lit("A").alias("status"),
        F.lit(None).cast("string").alias("direction_1"),
        F.lit(None).cast("string").alias("direction_2"),
        F.col("s_acctbal").alias("latitude"),
        F.col("s_nationkey").cast("double").alias("longitude"),
        F.struct(
            F.col("s_nationkey").cast("double").alias("lon"), F.col("s_acctbal").alias("lat")
        ).alias("location"),
    )


# Marts already built, by application, kind and folder: the test tables don't change,
# so the queries that read one report each share a mart.
_MARTS: dict[tuple[str, str, str], tuple[str, str]] = {}


def _mart(spark: SparkSession, sf_dir: str, kind: str, build) -> tuple[str, str]:
    key = (spark.sparkContext.applicationId, kind, sf_dir)
    if key not in _MARTS:
        _MARTS[key] = build(spark, sf_dir)
    return _MARTS[key]


def build_test_mart(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Land both raw tables from the test tables and build the four reports
    as stored tables, exactly as the jobs run (fresh databases per call)."""
    tag = os.path.basename(scratch_path(spark, "mart")).replace("-", "_")
    root = scratch_path(spark, "mart")
    raw_db, report_db = f"cl_raw_{tag}", f"cl_report_{tag}"
    publish_table(sensor_counts_view(spark, sf_dir), f"{raw_db}.{jobs.SENSOR_COUNTS}", root)
    publish_table(sensor_reference_view(spark, sf_dir), f"{raw_db}.{jobs.SENSOR_REFERENCE}", root)
    jobs.build_reports(
        spark, root, raw_db, report_db, n=10,
        decline_periods=(BASE, CURRENT), growth_periods=(CURRENT, LAST),
    )
    return raw_db, report_db


# ---------------------------------------------------------------- reports


def q_top_n_by_day(spark, sf_dir):
    return top_n_by_day(
        _lineitem(spark, sf_dir), _supplier(spark, sf_dir), n=10, **LINEITEM_COUNTS, **SUPPLIER_DIM
    )


def q_top_n_by_month(spark, sf_dir):
    daily = q_top_n_by_day(spark, sf_dir)
    return top_n_by_month(daily, _supplier(spark, sf_dir), n=10, **SUPPLIER_DIM)


def q_top_n_by_day_events(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    cents = ev.select(
        "ts", "user_id", F.round(F.col("value") * 100).cast("bigint").alias("cents")
    )
    return top_n_by_day(
        cents, table(spark, sf_dir, "customer"), n=10,
        ts_col="ts", id_col="user_id", value_col="cents",
        dim_key="c_custkey", label_col="c_name",
    )


def q_top_n_by_day_from_text(spark, sf_dir):
    counts = sensor_counts_view(spark, sf_dir)
    return top_n_by_day(counts, _supplier(spark, sf_dir), n=10, **SUPPLIER_DIM)


def q_decline_report(spark, sf_dir):
    return decline_report(
        _lineitem(spark, sf_dir), _supplier(spark, sf_dir),
        base=BASE, current=CURRENT, **LINEITEM_COUNTS, **SUPPLIER_DIM,
    )


def q_decline_report_from_text(spark, sf_dir):
    return decline_report(
        sensor_counts_view(spark, sf_dir), _supplier(spark, sf_dir),
        base=BASE, current=CURRENT, **SUPPLIER_DIM,
    )


def q_decline_report_missing_labels(spark, sf_dir):
    return decline_report(
        _lineitem(spark, sf_dir), _shifted_suppliers(spark, sf_dir), base=BASE, current=CURRENT,
        **LINEITEM_COUNTS, **SUPPLIER_DIM,
    )


def _shifted_suppliers(spark, sf_dir):
    """All suppliers, those of some nations under keys that no count has."""
    key = F.when(F.col("s_nationkey") < 20, F.col("s_suppkey")).otherwise(-1 - F.col("s_suppkey"))
    return _supplier(spark, sf_dir).withColumn("s_suppkey", key)


def q_growth_report(spark, sf_dir):
    return growth_report(
        _lineitem(spark, sf_dir), _supplier(spark, sf_dir),
        previous=CURRENT, last=LAST, **LINEITEM_COUNTS, **SUPPLIER_DIM,
    )


def q_period_total_half_open(spark, sf_dir):
    li = _lineitem(spark, sf_dir)
    return period_total(li, "l_shipdate", *HALF_OPEN, "l_suppkey", "l_quantity", "total").select(
        F.col("l_suppkey").alias("sensor_id"), F.col("total").cast("bigint").alias("total")
    )


def _label_miss_rows(spark, sf_dir):
    li = _lineitem(spark, sf_dir)
    totals = li.groupBy("l_suppkey").agg(F.sum("l_quantity").cast("bigint").alias("total"))
    labelled = with_label(totals, _shifted_suppliers(spark, sf_dir), "l_suppkey", "s_suppkey", "s_name", "location_name")
    return labelled.select(F.col("l_suppkey").alias("sensor_id"), "total", "location_name")


def q_label_left_join_miss(spark, sf_dir):
    return _label_miss_rows(spark, sf_dir)


# ----------------------------------------------------------- expressions


def q_reformat_datetime(spark, sf_dir):
    li = _lineitem(spark, sf_dir)
    raw = li.select(
        "l_orderkey",
        "l_linenumber",
        raw_count_time_text("l_shipdate", spark).alias("raw_text"),
    )
    return raw.select(
        "l_orderkey",
        "l_linenumber",
        "raw_text",
        format_iso(parse_local_time("raw_text", RAW_COUNT_TIME_FORMAT, spark=spark), spark).alias(
            "date_time"
        ),
        parse_local_time("raw_text", RAW_COUNT_TIME_FORMAT, spark=spark).cast("date").alias("day"),
    )


# ------------------------------------------------------- sources / sinks


def q_ingest_counts_csv(spark, sf_dir):
    landing = scratch_path(spark, "counts-csv")
    raw_count_file_rows(spark, sf_dir).write.option("header", True).csv(landing)
    return read_counts_csv(spark, landing, on_bad="fail")


def q_ingest_counts_stream(spark, sf_dir):
    landing = scratch_path(spark, "counts-landing")
    out = scratch_path(spark, "counts-stream-out")
    ckpt = scratch_path(spark, "counts-stream-ckpt")
    raw_count_file_rows(spark, sf_dir).write.option("header", True).csv(landing)
    header = ("ID", "Date_Time", "Year", "Sensor_ID", "Sensor_Name", "Hourly_Counts")
    q = stream_counts_csv(spark, landing, out, ckpt, raw_columns=header, on_bad="fail")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out)


def q_ingest_counts_stream_by_month(spark, sf_dir):
    landing = scratch_path(spark, "counts-landing-m")
    out = scratch_path(spark, "counts-stream-by-month")
    ckpt = scratch_path(spark, "counts-stream-by-month-ckpt")
    raw_count_file_rows(spark, sf_dir).write.option("header", True).csv(landing)
    header = ("ID", "Date_Time", "Year", "Sensor_ID", "Sensor_Name", "Hourly_Counts")
    q = stream_counts_csv(spark, landing, out, ckpt, raw_columns=header, on_bad="fail", by_month=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out)


def q_ingest_reference_json(spark, sf_dir):
    sup = _supplier(spark, sf_dir)
    records = sup.select(
        F.col("s_suppkey").cast("int").alias("location_id"),
        F.col("s_name").alias("sensor_description"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("sensor_name"),
        F.col("s_acctbal").alias("latitude"),
        F.col("s_nationkey").cast("double").alias("longitude"),
        F.struct(
            F.col("s_nationkey").cast("double").alias("lon"), F.col("s_acctbal").alias("lat")
        ).alias("location"),
    )
    landing = scratch_path(spark, "reference-json")
    records.write.json(landing)
    dim = read_reference_json(spark, landing, multi_line=False)
    return dim.select(
        "location_id",
        "sensor_description",
        "sensor_name",
        "installation_date",
        "latitude",
        "longitude",
        F.col("location.lon").alias("location_lon"),
        F.col("location.lat").alias("location_lat"),
    )


def q_overwrite_roundtrip(spark, sf_dir):
    sup = _supplier(spark, sf_dir)
    name = "countlens_rt_" + os.path.basename(scratch_path(spark, "t")).replace("-", "_")
    location = scratch_path(spark, "overwrite-table")
    register_table(spark, name, sup.schema, location)
    register_table(spark, name, sup.schema, location)  # idempotent
    overwrite_table(sup.withColumn("s_acctbal", -F.col("s_acctbal")), name)
    overwrite_table(sup, name)
    return spark.table(name)


def q_publish_roundtrip(spark, sf_dir):
    sup = _supplier(spark, sf_dir)
    name = "countlens_pub_" + os.path.basename(scratch_path(spark, "t")).replace("-", "_")
    root = scratch_path(spark, "published")
    publish_table(sup.withColumn("s_acctbal", -F.col("s_acctbal")), name, root)
    publish_table(sup, name, root)
    return spark.table(name)


def q_passthrough_view(spark, sf_dir):
    name = "countlens_nation_" + os.path.basename(scratch_path(spark, "v")).replace("-", "_")
    table(spark, sf_dir, "nation").createOrReplaceTempView(name + "_src")
    return passthrough_view(spark, name, name + "_src")


def q_publish_expired(spark, sf_dir):
    """A table published three times, whose superseded versions are removed."""
    root = scratch_path(spark, "expired")
    name = "cl_exp_" + os.path.basename(root).replace("-", "_") + ".suppliers"
    suppliers = _supplier(spark, sf_dir)
    for version in (suppliers.limit(0), suppliers.select("s_suppkey"), suppliers):
        publish_table(version, name, root)
    expire_versions(spark, name, root, 0)
    return spark.table(name)


def q_passthrough_view_permanent(spark, sf_dir):
    """A view in a database, over a stored table that has since been published again."""
    tag = os.path.basename(scratch_path(spark, "pv")).replace("-", "_")
    name, root = f"cl_raw{tag}.suppliers", scratch_path(spark, "viewed")
    suppliers = _supplier(spark, sf_dir)
    publish_table(suppliers.limit(0), name, root)
    passthrough_view(spark, f"cl_view{tag}.suppliers", name, temporary=False)
    publish_table(suppliers, name, root)
    return spark.table(f"cl_view{tag}.suppliers")


def q_preview(spark, sf_dir):
    return preview(
        _supplier(spark, sf_dir), 10, [F.col("s_acctbal").desc(), F.col("s_suppkey").asc()]
    )


# ---------------------------------------------------------------- checks


def q_check_not_null(spark, sf_dir):
    rows = _label_miss_rows(spark, sf_dir)
    return ck.run_checks(
        rows,
        [ck.not_null("sensor_id"), ck.not_null("total"), ck.not_null("location_name")],
        "label_left_join_miss",
    )


def q_check_unique(spark, sf_dir):
    a = ck.run_checks(_lineitem(spark, sf_dir), [ck.unique("l_orderkey")], "lineitem")
    b = ck.run_checks(_supplier(spark, sf_dir), [ck.unique("s_suppkey")], "supplier")
    return a.unionByName(b)


def q_check_accepted_values(spark, sf_dir):
    return ck.run_checks(
        table(spark, sf_dir, "customer"),
        [ck.accepted_values("c_mktsegment", ["BUILDING", "AUTOMOBILE", "MACHINERY"])],
        "customer",
    )


def _formatted_days(spark, sf_dir):
    li = _lineitem(spark, sf_dir)
    d = F.col("l_shipdate")
    return li.select(
        F.when(F.col("l_linenumber") == 3, F.date_format(d, "dd/MM/yyyy"))
        .when(F.col("l_linenumber") == 5, F.lit(None).cast("string"))
        .otherwise(F.date_format(d, DATE_FORMAT))
        .alias("day_text"),
        F.when(F.col("l_linenumber") == 1, F.date_format(d, ISO_LOCAL_FORMAT + "'Z'"))
        .when(F.col("l_linenumber") == 2, F.date_format(d, "yyyy-MM-dd' 'HH:mm:ss"))
        .when(F.col("l_linenumber") == 4, F.date_format(d, ISO_LOCAL_FORMAT + "'.123+10:00'"))
        .when(F.col("l_linenumber") == 5, F.lit(None).cast("string"))
        .otherwise(F.date_format(d, ISO_LOCAL_FORMAT))
        .alias("time_text"),
    )


def q_check_date_format(spark, sf_dir):
    return ck.run_checks(_formatted_days(spark, sf_dir), [ck.is_date_format("day_text")], "lineitem")


def q_check_iso_format(spark, sf_dir):
    return ck.run_checks(_formatted_days(spark, sf_dir), [ck.is_iso_format("time_text")], "lineitem")


def q_check_iso_format_strict(spark, sf_dir):
    return ck.run_checks(
        _formatted_days(spark, sf_dir),
        [ck.is_iso_format("time_text", require_offset=True)],
        "lineitem_strict",
    )


def q_check_non_negative(spark, sf_dir):
    return ck.run_checks(
        table(spark, sf_dir, "customer"), [ck.non_negative("c_acctbal")], "customer"
    )


def q_check_id_range(spark, sf_dir):
    return ck.run_checks(_supplier(spark, sf_dir), [ck.in_range("s_suppkey", 0, 50)], "supplier")


def q_check_rank_range(spark, sf_dir):
    report = top_n_by_day(
        _lineitem(spark, sf_dir), _supplier(spark, sf_dir), n=12, ordered=False,
        **LINEITEM_COUNTS, **SUPPLIER_DIM,
    )
    return ck.run_checks(report, ck.top_n_by_day_checks(10), "report_top_n_by_day")


def q_sensor_counts_data_tests(spark, sf_dir):
    return ck.run_checks(
        sensor_counts_view(spark, sf_dir), ck.sensor_counts_checks(), "sensor_counts"
    )


def q_violations_unique(spark, sf_dir):
    return ck.violations(_lineitem(spark, sf_dir), ck.unique("l_orderkey")).select(
        F.col("value").alias("l_orderkey"), "n_records"
    )


def q_violations_non_negative(spark, sf_dir):
    return ck.violations(table(spark, sf_dir, "customer"), ck.non_negative("c_acctbal"))


# ------------------------------------------------------ stored-table jobs


def _land_counts_by_month(spark, sf_dir):
    """Land lineitem as a count file, ingest it into a month-partitioned
    table, then land and ingest one month again (it must replace, not add)."""
    tag = os.path.basename(scratch_path(spark, "m")).replace("-", "_")
    raw_db = f"cl_rawm_{tag}"
    rows = raw_count_file_rows(spark, sf_dir)
    landing = scratch_path(spark, "counts-by-month")
    rows.write.option("header", True).csv(landing)
    location = scratch_path(spark, "counts-by-month-table")
    name = jobs.ingest_counts_by_month(spark, landing, location, raw_db)
    relanding = scratch_path(spark, "counts-relanding")
    rows.filter(F.col("Date_Time").startswith("March")).filter(
        F.col("Date_Time").contains(", 1996 ")
    ).write.option("header", True).csv(relanding)
    jobs.ingest_counts_by_month(spark, relanding, location, raw_db)
    return name


def q_ingest_counts_by_month(spark, sf_dir):
    return spark.table(_land_counts_by_month(spark, sf_dir))


def q_decline_report_month_pruned(spark, sf_dir):
    counts = spark.table(_land_counts_by_month(spark, sf_dir))
    return decline_report(
        counts, _supplier(spark, sf_dir), base=BASE, current=CURRENT,
        month_col=jobs.MONTH_COL, **SUPPLIER_DIM,
    )


def build_incremental_mart(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The month-partitioned layout end to end: land lineitem as a count
    file whose March 1996 counts are doubled, merge it by month and keep the
    day totals, check failures and duplicate ids by month; then re-land March
    1996 with the right counts (every table must replace that month only);
    build the four reports from the day totals alone. A batch is parsed once,
    and the kept tables come from the stored months it touched."""
    tag = os.path.basename(scratch_path(spark, "i")).replace("-", "_")
    raw_db, report_db = f"cl_rawi_{tag}", f"cl_reporti_{tag}"
    root = scratch_path(spark, "inc-mart")
    rows = raw_count_file_rows(spark, sf_dir)
    march_1996 = F.col("Date_Time").startswith("March") & F.col("Date_Time").contains(", 1996 ")
    first = scratch_path(spark, "inc-landing")
    rows.withColumn(
        "Hourly_Counts",
        F.when(march_1996, (F.col("Hourly_Counts").cast("int") * 2).cast("string")).otherwise(
            F.col("Hourly_Counts")
        ),
    ).write.option("header", True).csv(first)
    again = scratch_path(spark, "inc-relanding")
    rows.filter(march_1996).write.option("header", True).csv(again)
    publish_table(sensor_reference_view(spark, sf_dir), f"{raw_db}.{jobs.SENSOR_REFERENCE}", root)
    counts_at, totals_at = scratch_path(spark, "inc-counts"), scratch_path(spark, "inc-day-totals")
    failures_at = scratch_path(spark, "inc-check-failures")
    twice_at = scratch_path(spark, "inc-duplicate-ids")
    for landing in (first, again):
        months = jobs.merge_counts(spark, jobs.land_counts(spark, landing), counts_at, raw_db)
        jobs.refresh_day_totals(spark, months, totals_at, report_db)
        jobs.refresh_check_failures(spark, months, failures_at, report_db)
        jobs.refresh_duplicate_ids(spark, months, twice_at, raw_db, report_db)
    jobs.build_reports(
        spark, root, raw_db, report_db, n=10,
        decline_periods=(BASE, CURRENT), growth_periods=(CURRENT, LAST),
        day_totals_table=f"{report_db}.{jobs.DAY_TOTALS}",
    )
    return raw_db, report_db


def q_incremental_day_totals(spark, sf_dir):
    _, report_db = _mart(spark, sf_dir, "incremental", build_incremental_mart)
    return spark.table(f"{report_db}.{jobs.DAY_TOTALS}").drop("day_text")


def q_incremental_top_n_by_day(spark, sf_dir):
    _, report_db = _mart(spark, sf_dir, "incremental", build_incremental_mart)
    return spark.table(f"{report_db}.{jobs.TOP_BY_DAY}")


def q_incremental_top_n_by_month(spark, sf_dir):
    _, report_db = _mart(spark, sf_dir, "incremental", build_incremental_mart)
    return spark.table(f"{report_db}.{jobs.TOP_BY_MONTH}")


def q_incremental_decline_report(spark, sf_dir):
    _, report_db = _mart(spark, sf_dir, "incremental", build_incremental_mart)
    return spark.table(f"{report_db}.{jobs.DECLINES}")


def q_incremental_growth_report(spark, sf_dir):
    _, report_db = _mart(spark, sf_dir, "incremental", build_incremental_mart)
    return spark.table(f"{report_db}.{jobs.GROWTH}")


def q_incremental_data_tests(spark, sf_dir):
    raw_db, report_db = _mart(spark, sf_dir, "incremental", build_incremental_mart)
    return jobs.data_tests(
        spark, raw_db, report_db,
        check_failures_table=f"{report_db}.{jobs.CHECK_FAILURES}",
        duplicate_ids_table=f"{report_db}.{jobs.DUPLICATE_IDS}",
    )


def q_stored_day_totals(spark, sf_dir):
    _, report_db = _mart(spark, sf_dir, "stored", build_test_mart)
    return spark.table(f"{report_db}.{jobs.DAY_TOTALS}").drop("day_text")


def q_stored_top_n_by_day(spark, sf_dir):
    _, report_db = _mart(spark, sf_dir, "stored", build_test_mart)
    return spark.table(f"{report_db}.{jobs.TOP_BY_DAY}")


def q_stored_top_n_by_month(spark, sf_dir):
    _, report_db = _mart(spark, sf_dir, "stored", build_test_mart)
    return spark.table(f"{report_db}.{jobs.TOP_BY_MONTH}")


def q_stored_decline_report(spark, sf_dir):
    _, report_db = _mart(spark, sf_dir, "stored", build_test_mart)
    return spark.table(f"{report_db}.{jobs.DECLINES}")


def q_stored_growth_report(spark, sf_dir):
    _, report_db = _mart(spark, sf_dir, "stored", build_test_mart)
    return spark.table(f"{report_db}.{jobs.GROWTH}")


def q_stored_data_tests(spark, sf_dir):
    raw_db, report_db = _mart(spark, sf_dir, "stored", build_test_mart)
    return jobs.data_tests(spark, raw_db, report_db)


# ------------------------------------- odd files, late rows, malformed times


def q_ingest_counts_mixed_headers(spark, sf_dir):
    """Files whose headers have another order and other extra columns."""
    rows = raw_count_file_rows(spark, sf_dir)
    odd = F.col("ID").cast("long") % 2 == 1
    landing = scratch_path(spark, "counts-mixed")
    rows.filter(~odd).write.option("header", True).csv(landing)
    other = rows.filter(odd).select("Hourly_Counts", "Sensor_Name", "ID", "Sensor_ID", "Date_Time")
    other.write.mode("append").option("header", True).csv(landing)
    return read_counts_csv(spark, landing, mixed_headers=True)


def q_ingest_counts_wide_ids(spark, sf_dir):
    """Ids beyond the range of an int."""
    rows = raw_count_file_rows(spark, sf_dir)
    landing = scratch_path(spark, "counts-wide")
    wide = (F.col("ID").cast("long") + 3_000_000_000).cast("string")
    rows.withColumn("ID", wide).write.option("header", True).csv(landing)
    return read_counts_csv(spark, landing)


def q_ingest_counts_bad_lines(spark, sf_dir):
    """Short and long lines and empty fields are kept, with what is wrong, for quarantine."""
    li = _lineitem(spark, sf_dir)
    fields = [
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string"),
        raw_count_time_text("l_shipdate", spark),
        F.col("l_suppkey").cast("string"),
        F.lit("name"),
        F.col("l_quantity").cast("int").cast("string"),
    ]
    full = F.concat_ws(",", *(F.concat(F.lit('"'), x, F.lit('"')) for x in fields))
    line = (
        F.when(F.col("l_linenumber") == 2, F.concat_ws(",", fields[0], F.lit("short")))
        .when(F.col("l_linenumber") == 3, F.concat(full, F.lit(",extra")))
        .when(F.col("l_linenumber") == 4, F.concat(fields[0], F.lit(",,,,")))
        .otherwise(full)
    )
    landing = scratch_path(spark, "counts-bad-lines")
    li.select(line.alias("ID,Date_Time,Sensor_ID,Sensor_Name,Hourly_Counts")).write.option("header", True).option(
        "quote", "\u0000"
    ).option("sep", "\u0001").option("escapeQuotes", False).csv(landing)
    got = read_counts_csv(spark, landing, on_bad="null", bad_line_col="bad_line")
    return got.select("id", "date_time", "hourly_count", F.col("bad_line").isNotNull().alias("is_bad_line"))


def q_incremental_late_rows(spark, sf_dir):
    """A late batch with some days of a stored month: the month's other days stay."""
    raw_db = "cl_rawl_" + os.path.basename(scratch_path(spark, "l")).replace("-", "_")
    location = scratch_path(spark, "late-table")
    rows = raw_count_file_rows(spark, sf_dir)
    march_1996 = F.col("Date_Time").startswith("March") & F.col("Date_Time").contains(", 1996 ")
    late = march_1996 & (F.substring("Date_Time", 7, 2) >= "15")
    for part in (~late, late):
        landing = scratch_path(spark, "late-landing")
        rows.filter(part).write.option("header", True).csv(landing)
        name = jobs.ingest_counts_by_month(spark, landing, location, raw_db)
    return spark.table(name)


def unique_id():
    """An id that no two lineitems share (the keys alone repeat in the test tables)."""
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1994-01-01").cast("date"))
    return ((F.col("l_orderkey") * 32768 + F.col("l_partkey")) * 4096 + day) * 8 + F.col("l_linenumber")


def build_batch_mart(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A mart that takes three landings of folders. The first has bad times, times that are a
    year late, and rows that stand twice, in two months; the second, of other rows, takes over
    some ids of the first; the third is the first folder again, corrected, but with other rows
    standing twice (once with a count of 0). Its writer is lost on the way, and it is resumed."""
    tag = os.path.basename(scratch_path(spark, "k")).replace("-", "_")
    raw_db, report_db = f"cl_rawk_{tag}", f"cl_reportk_{tag}"
    publish_table(sensor_reference_view(spark, sf_dir), f"{raw_db}.{jobs.SENSOR_REFERENCE}", scratch_path(spark, "batch-dim"))
    li = _lineitem(spark, sf_dir).withColumn("id", unique_id())
    labelled = with_label(li, _supplier(spark, sf_dir), "l_suppkey", "s_suppkey", "s_name", "sensor_name")

    def rows(of, time=None, count="l_quantity"):
        right = raw_count_time_text("l_shipdate", spark)
        return labelled.filter(of).select(
            F.col("id").cast("string").alias("ID"),
            (right if time is None else time(right)).alias("Date_Time"),
            F.col("l_suppkey").cast("string").alias("Sensor_ID"),
            F.col("sensor_name").alias("Sensor_Name"),
            (F.lit(count) if count == "0" else F.col(count).cast("int").cast("string")).alias("Hourly_Counts"),
        )

    late = raw_count_time_text("year_later", spark)
    labelled = labelled.withColumn("year_later", F.col("l_shipdate") + F.expr("interval 1 year"))
    first, line = F.col("l_linenumber") <= 4, F.col("id")
    wrong = rows(first, lambda t: F.when(line % 97 == 5, "no time").when(line % 101 == 7, late).otherwise(t))
    wrong = wrong.unionByName(rows(first & (line % 89 == 3), lambda t: late))
    mart = CountMart(spark, scratch_path(spark, "batch-mart"), raw_db, report_db, id_ranges=8)
    a, b = scratch_path(spark, "batch-folder"), scratch_path(spark, "batch-folder")
    wrong.write.option("header", True).csv(a)
    mart.apply("first", a, on_bad="null", by_folder=True)
    taken_over = rows(first & (line % 103 == 4), lambda t: late)
    rows(~first).unionByName(taken_over).write.option("header", True).csv(b)
    mart.apply("second", b, on_bad="null", by_folder=True)
    right = rows(first).unionByName(rows(first & (line % 211 == 8), count="0"))
    right.write.option("header", True).mode("overwrite").csv(a)

    class Lost(Exception):
        pass

    def lose(step):
        if step == "ids":
            raise Lost

    mart.on_step = lose
    try:
        mart.apply("third", a, on_bad="null", by_folder=True)
    except Lost:
        mart.on_step = None
        mart.resume()
    return raw_db, report_db


def q_incremental_corrected_file(spark, sf_dir):
    """The stored counts after a folder is landed again, corrected: exactly its rows, in their months."""
    raw_db, _ = _mart(spark, sf_dir, "batches", build_batch_mart)
    return spark.table(f"{raw_db}.{jobs.SENSOR_COUNTS}").drop("file_key")


def q_incremental_duplicates_taken_back(spark, sf_dir):
    """Ids that stand more than once after three landings, each of which changes which do."""
    _, report_db = _mart(spark, sf_dir, "batches", build_batch_mart)
    return spark.table(f"{report_db}.{jobs.DUPLICATE_IDS}").select("id", "n")


def q_incremental_batch_day_totals(spark, sf_dir):
    _, report_db = _mart(spark, sf_dir, "batches", build_batch_mart)
    return spark.table(f"{report_db}.{jobs.DAY_TOTALS}")


def q_incremental_ranking_by_day(spark, sf_dir):
    """The daily ranking kept by month."""
    _, report_db = _mart(spark, sf_dir, "batches", build_batch_mart)
    return spark.table(f"{report_db}.{jobs.TOP_BY_DAY}").drop("part")


def q_incremental_ranking_by_month(spark, sf_dir):
    """The monthly ranking kept by month, from the touched months of the daily one."""
    _, report_db = _mart(spark, sf_dir, "batches", build_batch_mart)
    return spark.table(f"{report_db}.{jobs.TOP_BY_MONTH}").drop("part")


def _bad_time_counts(spark, sf_dir):
    """Counts of which some have a clock that is no time of day."""
    counts = sensor_counts_view(spark, sf_dir)
    bad = F.concat(F.substring("date_time", 1, 10), F.lit("T99:00:00"))
    return counts.withColumn("date_time", F.when(F.col("id") % 8 == 2, bad).otherwise(F.col("date_time")))


def q_decline_report_bad_times(spark, sf_dir):
    counts = _bad_time_counts(spark, sf_dir)
    return decline_report(counts, _supplier(spark, sf_dir), base=BASE, current=CURRENT, **SUPPLIER_DIM)


def _bad_time_mart(spark, sf_dir, by_month: bool):
    tag = os.path.basename(scratch_path(spark, "b")).replace("-", "_")
    root, raw_db, report_db = scratch_path(spark, "bad-time-mart"), f"cl_rawb_{tag}", f"cl_reportb_{tag}"
    counts, totals = _bad_time_counts(spark, sf_dir), None
    publish_table(sensor_reference_view(spark, sf_dir), f"{raw_db}.{jobs.SENSOR_REFERENCE}", root)
    if by_month:
        batch = counts.withColumn(jobs.MONTH_COL, F.substring("date_time", 1, 7))
        months = jobs.merge_counts(spark, batch, scratch_path(spark, "bad-time-counts"), raw_db)
        totals = jobs.refresh_day_totals(spark, months, scratch_path(spark, "bad-time-totals"), report_db)
    else:
        publish_table(counts, f"{raw_db}.{jobs.SENSOR_COUNTS}", root)
    jobs.build_reports(
        spark, root, raw_db, report_db, decline_periods=(BASE, CURRENT), growth_periods=(CURRENT, LAST),
        day_totals_table=totals,
    )
    return spark.table(f"{report_db}.{jobs.DECLINES}")


def q_stored_decline_report_bad_times(spark, sf_dir):
    return _bad_time_mart(spark, sf_dir, by_month=False)


def q_incremental_decline_report_bad_times(spark, sf_dir):
    return _bad_time_mart(spark, sf_dir, by_month=True)


def _reference_record():
    return F.struct(
        F.col("s_suppkey").cast("int").alias("location_id"),
        F.col("s_name").alias("sensor_description"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("sensor_name"),
        F.col("s_acctbal").alias("latitude"),
        F.col("s_nationkey").cast("double").alias("longitude"),
        F.struct(F.col("s_nationkey").cast("double").alias("lon"), F.col("s_acctbal").alias("lat")).alias("location"),
    )


def _reference_columns(dim):
    return dim.select(
        "location_id", "sensor_description", "sensor_name", "installation_date", "latitude", "longitude",
        F.col("location.lon").alias("location_lon"), F.col("location.lat").alias("location_lat"),
    )


def q_ingest_reference_json_split(spark, sf_dir):
    """One JSON array file of all sensors, read by byte ranges."""
    sup = _supplier(spark, sf_dir)
    lines = sup.select(F.col("s_suppkey").alias("k"), F.to_json(_reference_record()).alias("value"))
    last = sup.agg(F.max("s_suppkey")).first()[0]
    lines = lines.withColumn("value", F.when(F.col("k") < last, F.concat("value", F.lit(","))).otherwise(F.concat("value", F.lit("]"))))
    lines = lines.unionByName(spark.range(1).select(F.lit(None).cast("bigint").alias("k"), F.lit("[").alias("value")))
    landing = scratch_path(spark, "reference-json-split")
    lines.coalesce(1).sortWithinPartitions(F.col("k").asc_nulls_first()).select("value").write.text(landing)
    return _reference_columns(read_json_array(spark, landing, schemas.SENSOR_REFERENCE))


def q_ingest_reference_json_array(spark, sf_dir):
    """Files that hold one JSON array each, of at most 16 records."""
    sup = _supplier(spark, sf_dir)
    record = _reference_record()
    part = F.floor(F.col("s_suppkey") / 16).alias("part")
    arrays = sup.groupBy(part).agg(F.to_json(F.collect_list(record)).alias("value"))
    landing = scratch_path(spark, "reference-json-array")
    arrays.write.partitionBy("part").text(landing)
    root, raw_db = scratch_path(spark, "reference-array"), "cl_refa_" + os.path.basename(scratch_path(spark, "r")).replace("-", "_")
    jobs.ingest_reference(spark, os.path.join(landing, "part=*"), root, raw_db, multi_line=True)
    return _reference_columns(spark.table(f"{raw_db}.{jobs.SENSOR_REFERENCE}"))


# ------------------------------------------------ order, types, any n, checks


def q_top_n_by_day_ordered(spark, sf_dir):
    return top_n_by_day(
        _lineitem(spark, sf_dir), _supplier(spark, sf_dir), n=10, ordered=True, **LINEITEM_COUNTS, **SUPPLIER_DIM
    )


def q_stored_top_n_by_day_int(spark, sf_dir):
    """The stored daily ranking, sorted and in the narrow count type."""
    tag = os.path.basename(scratch_path(spark, "n")).replace("-", "_")
    root, raw_db, report_db = scratch_path(spark, "int-mart"), f"cl_rawn_{tag}", f"cl_reportn_{tag}"
    publish_table(sensor_counts_view(spark, sf_dir), f"{raw_db}.{jobs.SENSOR_COUNTS}", root)
    publish_table(sensor_reference_view(spark, sf_dir), f"{raw_db}.{jobs.SENSOR_REFERENCE}", root)
    jobs.build_reports(
        spark, root, raw_db, report_db, decline_periods=(BASE, CURRENT), growth_periods=(CURRENT, LAST),
        ordered=True, count_type="int",
    )
    return spark.table(f"{report_db}.{jobs.TOP_BY_DAY}")


def q_top_1500_by_year(spark, sf_dir):
    """A ranking beyond the length to which Spark limits windows before their shuffle."""
    li = _lineitem(spark, sf_dir).withColumn("year", F.year("l_shipdate"))
    return top_n_by_period(li, "year", "l_orderkey", "l_quantity", 1500, "total")


def q_ranks_of_hot_periods(spark, sf_dir):
    """A million places of two periods that hold all rows: ranked by ranges, never in one task a period."""
    totals = _lineitem(spark, sf_dir).groupBy("l_linestatus", "l_orderkey").agg(F.sum("l_quantity").alias("total"))
    return rank_by_range(totals, "l_linestatus", "l_orderkey", "total", 1_000_000)


def q_period_total_midday_of_dates(spark, sf_dir):
    li = _lineitem(spark, sf_dir).withColumn("day", F.to_date("l_shipdate"))
    total = period_total(li, "day", "1996-03-01T12:00:00", "1996-03-31T12:00:00", "l_suppkey", "l_quantity", "total")
    return total.select(F.col("l_suppkey").alias("sensor_id"), F.col("total").cast("bigint").alias("total"))


def q_check_formats_with_line_breaks(spark, sf_dir):
    """Values that end in a line break fail the format checks."""
    d = F.col("l_shipdate")
    end = F.when(F.col("l_linenumber") == 1, F.lit("\n")).otherwise(F.lit(""))
    rows = _lineitem(spark, sf_dir).select(
        F.concat(F.date_format(d, DATE_FORMAT), end).alias("day_text"),
        F.concat(F.date_format(d, ISO_LOCAL_FORMAT), end).alias("time_text"),
    )
    return ck.run_checks(rows, [ck.is_date_format("day_text"), ck.is_iso_format("time_text")], "lineitem")


def _defective_counts(spark, sf_dir):
    """Counts with short times, missing names and negative counts."""
    counts = sensor_counts_view(spark, sf_dir)
    time = F.when(F.col("id") % 8 == 2, F.substring("date_time", 1, 10)).otherwise(F.col("date_time"))
    counts = counts.withColumn("date_time", time).withColumn("hourly_count", F.col("hourly_count") - 3)
    return counts.withColumn("sensor_name", F.when(F.col("id") % 5 != 0, F.col("sensor_name")))


def q_violations_all_checks(spark, sf_dir):
    """The failing rows of all row-level checks of the counts, from one scan."""
    checks = [c for c in ck.sensor_counts_checks() if c.kind == "row"]
    return ck.failing_rows(_defective_counts(spark, sf_dir), checks, ["id", "date_time", "hourly_count"])


def q_ingest_quarantine(spark, sf_dir):
    """A landing in which some lines are bad: per file, the lines that are good and those set aside, by reason."""
    number = F.col("ID").cast("long")
    rows = raw_count_file_rows(spark, sf_dir)
    rows = rows.withColumn("Date_Time", F.when(number % 97 == 5, "soon").otherwise(F.col("Date_Time")))
    rows = rows.withColumn("Hourly_Counts", F.when(number % 89 == 3, "many").otherwise(F.col("Hourly_Counts")))
    rows = rows.withColumn("Sensor_Name", F.when(number % 83 != 2, F.col("Sensor_Name")))
    landing = scratch_path(spark, "quarantine-landing")
    rows.write.option("header", True).csv(landing)
    landed = land_with_quarantine(spark, landing, scratch_path(spark, "quarantine"), max_bad_share=0.5)
    return landed.counts.groupBy("reason").agg(F.sum("n_lines").alias("n_lines"))


def q_violations_not_null(spark, sf_dir):
    return ck.violations(_label_miss_rows(spark, sf_dir), ck.not_null("location_name"))


def q_violations_accepted_values(spark, sf_dir):
    check = ck.accepted_values("c_mktsegment", ["BUILDING", "AUTOMOBILE", "MACHINERY"])
    return ck.violations(table(spark, sf_dir, "customer"), check)


def q_violations_date_format(spark, sf_dir):
    return ck.violations(_formatted_days(spark, sf_dir), ck.is_date_format("day_text"))


def q_violations_iso_format(spark, sf_dir):
    return ck.violations(_formatted_days(spark, sf_dir), ck.is_iso_format("time_text"))


def q_violations_id_range(spark, sf_dir):
    return ck.violations(_supplier(spark, sf_dir), ck.in_range("s_suppkey", 0, 50))


def q_violations_rank_range(spark, sf_dir):
    report = top_n_by_day(
        _lineitem(spark, sf_dir), _supplier(spark, sf_dir), n=12, **LINEITEM_COUNTS, **SUPPLIER_DIM
    )
    return ck.violations(report, ck.accepted_values("rank", range(1, 11), name="rank_range"))


QUERIES = {
    "top_n_by_day": q_top_n_by_day,
    "top_n_by_month": q_top_n_by_month,
    "top_n_by_day_events": q_top_n_by_day_events,
    "top_n_by_day_from_text": q_top_n_by_day_from_text,
    "decline_report": q_decline_report,
    "decline_report_from_text": q_decline_report_from_text,
    "decline_report_missing_labels": q_decline_report_missing_labels,
    "growth_report": q_growth_report,
    "period_total_half_open": q_period_total_half_open,
    "label_left_join_miss": q_label_left_join_miss,
    "reformat_datetime": q_reformat_datetime,
    "ingest_counts_csv": q_ingest_counts_csv,
    "ingest_counts_stream": q_ingest_counts_stream,
    "ingest_counts_stream_by_month": q_ingest_counts_stream_by_month,
    "ingest_reference_json": q_ingest_reference_json,
    "overwrite_roundtrip": q_overwrite_roundtrip,
    "publish_roundtrip": q_publish_roundtrip,
    "passthrough_view": q_passthrough_view,
    "preview": q_preview,
    "check_not_null": q_check_not_null,
    "check_unique": q_check_unique,
    "check_accepted_values": q_check_accepted_values,
    "check_date_format": q_check_date_format,
    "check_iso_format": q_check_iso_format,
    "check_iso_format_strict": q_check_iso_format_strict,
    "check_non_negative": q_check_non_negative,
    "check_id_range": q_check_id_range,
    "check_rank_range": q_check_rank_range,
    "sensor_counts_data_tests": q_sensor_counts_data_tests,
    "violations_unique": q_violations_unique,
    "violations_non_negative": q_violations_non_negative,
    "stored_day_totals": q_stored_day_totals,
    "stored_top_n_by_day": q_stored_top_n_by_day,
    "stored_top_n_by_month": q_stored_top_n_by_month,
    "stored_decline_report": q_stored_decline_report,
    "stored_growth_report": q_stored_growth_report,
    "stored_data_tests": q_stored_data_tests,
    "ingest_counts_by_month": q_ingest_counts_by_month,
    "decline_report_month_pruned": q_decline_report_month_pruned,
    "incremental_day_totals": q_incremental_day_totals,
    "incremental_top_n_by_day": q_incremental_top_n_by_day,
    "incremental_top_n_by_month": q_incremental_top_n_by_month,
    "incremental_decline_report": q_incremental_decline_report,
    "incremental_growth_report": q_incremental_growth_report,
    "incremental_data_tests": q_incremental_data_tests,
    "ingest_counts_mixed_headers": q_ingest_counts_mixed_headers,
    "ingest_counts_wide_ids": q_ingest_counts_wide_ids,
    "ingest_counts_bad_lines": q_ingest_counts_bad_lines,
    "incremental_late_rows": q_incremental_late_rows,
    "incremental_corrected_file": q_incremental_corrected_file,
    "incremental_duplicates_taken_back": q_incremental_duplicates_taken_back,
    "incremental_batch_day_totals": q_incremental_batch_day_totals,
    "incremental_ranking_by_day": q_incremental_ranking_by_day,
    "incremental_ranking_by_month": q_incremental_ranking_by_month,
    "decline_report_bad_times": q_decline_report_bad_times,
    "stored_decline_report_bad_times": q_stored_decline_report_bad_times,
    "incremental_decline_report_bad_times": q_incremental_decline_report_bad_times,
    "ingest_reference_json_split": q_ingest_reference_json_split,
    "publish_expired": q_publish_expired,
    "passthrough_view_permanent": q_passthrough_view_permanent,
    "ingest_reference_json_array": q_ingest_reference_json_array,
    "top_n_by_day_ordered": q_top_n_by_day_ordered,
    "stored_top_n_by_day_int": q_stored_top_n_by_day_int,
    "top_1500_by_year": q_top_1500_by_year,
    "ranks_of_hot_periods": q_ranks_of_hot_periods,
    "period_total_midday_of_dates": q_period_total_midday_of_dates,
    "check_formats_with_line_breaks": q_check_formats_with_line_breaks,
    "violations_all_checks": q_violations_all_checks,
    "ingest_quarantine": q_ingest_quarantine,
    "violations_not_null": q_violations_not_null,
    "violations_accepted_values": q_violations_accepted_values,
    "violations_date_format": q_violations_date_format,
    "violations_iso_format": q_violations_iso_format,
    "violations_id_range": q_violations_id_range,
    "violations_rank_range": q_violations_rank_range,
}
