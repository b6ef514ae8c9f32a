"""End-to-end jobs on the report fixture: land raw files, build the stored
reports (the monthly one from the stored daily one), run the data tests."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_text
from countlens.plans import jobs
from countlens.session import scratch_path
from tests.test_reports import RAW


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_jobs_end_to_end(spark):
    land = local(scratch_path(spark, "land"))
    os.makedirs(os.path.join(land, "csv"))
    os.makedirs(os.path.join(land, "json"))
    with open(os.path.join(land, "csv", "counts.csv"), "w") as f:
        f.write("ID,Date_Time,Sensor_ID,Sensor_Name,Hourly_Counts\n")
        for r in RAW:
            f.write(f'{r[0]},"{r[1]}",{r[2]},{r[3]},{r[4]}\n')
    dim = [
        {"location_id": 1, "sensor_description": "Town Hall", "location_type": "Outdoor",
         "status": "A", "latitude": -37.8, "longitude": 144.9, "installation_date": "2009-05-01"},
        {"location_id": 2, "sensor_description": "Bridge", "location_type": "Outdoor Blix",
         "status": "A", "latitude": -37.8, "longitude": 144.9},
        {"location_id": 3, "sensor_description": "Station", "location_type": "Indoor",
         "status": "A", "latitude": -37.8, "longitude": 144.9, "direction_1": "North"},
    ]
    with open(os.path.join(land, "json", "ref.json"), "w") as f:
        json.dump(dim, f)

    root = scratch_path(spark, "mart")
    jobs.ingest_counts(spark, os.path.join(land, "csv"), root, raw_db="e2e_raw")
    jobs.ingest_reference(spark, os.path.join(land, "json"), root, raw_db="e2e_raw", multi_line=True)
    jobs.build_reports(spark, root, raw_db="e2e_raw", report_db="e2e_report", n=2)

    daily = spark.table(f"e2e_report.{jobs.TOP_BY_DAY}")
    assert daily.count() == 9
    monthly = {
        (r.year_month, r.rank): (r.sensor_id, r.monthly_count)
        for r in spark.table(f"e2e_report.{jobs.TOP_BY_MONTH}").collect()
    }
    assert monthly[("2021-11", 1)] == (9, 60) and monthly[("2021-11", 2)] == (1, 50)
    decline = sorted(
        (r.sensor_id, r.decline, r.decline_percent)
        for r in spark.table(f"e2e_report.{jobs.DECLINES}").collect()
    )
    assert decline == [(1, 150, 75.0), (2, 150, 75.0)]
    growth = sorted(
        (r.sensor_id, r.growth) for r in spark.table(f"e2e_report.{jobs.GROWTH}").collect()
    )
    assert growth == [(1, 10), (3, 5)]

    # rebuilding publishes new versions; readers see the new data only
    jobs.build_reports(spark, root, raw_db="e2e_raw", report_db="e2e_report", n=1)
    assert spark.table(f"e2e_report.{jobs.TOP_BY_DAY}").count() == 7  # one per day

    res = {
        (r.table_name, r.column_name, r.check_name): r.failures
        for r in jobs.data_tests(spark, "e2e_raw", "e2e_report", n=1).collect()
    }
    assert res[("sensor_counts", "id", "unique")] == 0
    assert res[("sensor_reference_data", "location_type", "accepted_values")] == 0
    assert res[("sensor_reference_data", "installation_date", "is_date_format")] == 0
    assert res[("report_top_10_locations_by_day", "rank", "rank_range")] == 0
    assert len(res) == 9 + 12 + 6


def test_day_totals_path_equals_per_report_scans(spark):
    """The default job path (one scan into stored day totals) writes the same
    four reports as one scan of the raw counts per report, also for NULL
    values, NULL keys, unparseable times and period boundaries."""
    from countlens.schemas import SENSOR_COUNTS as SCHEMA
    from countlens.sources.tables import publish_table

    rows = [
        (1, "2018-11-01T00:00:00", 1, "A", 100),  # first instant of the base year
        (2, "2019-10-31T23:59:59", 1, "A", 100),  # last second of the base year
        (3, "2019-11-01T00:00:00", 1, "A", 7),  # first instant after it
        (4, "2021-11-05T09:00:00", 1, "A", 50),
        (5, "2022-10-31T23:00:00", 2, "B", 30),
        (6, "2019-03-01T10:00:00", 2, "B", 20),
        (7, "2019-03-01T11:00:00", 4, "D", None),  # all-NULL values in both years
        (8, "2022-03-01T11:00:00", 4, "D", None),
        (9, "2019-03-01T11:00:00", None, "N", 5),  # NULL key
        (10, "2022-03-01T11:00:00", None, "N", 5),
        (11, "junk", 1, "A", 9),  # unparseable: no period, one NULL day
        (12, None, 2, "B", 3),
        (13, "2020-12-24T08:00:00", 3, "C", 0),  # previous year only
        (14, "2021-01-02T08:00:00", 2, "B", 11),
        (15, "2022-11-01T00:00:00", 2, "B", 999),  # end bound is exclusive
    ]
    dim = spark.createDataFrame(
        [(1, "Town Hall"), (2, "Bridge"), (3, "Station")],
        "location_id int, sensor_description string",
    )
    root = scratch_path(spark, "mart-eq")
    publish_table(spark.createDataFrame(rows, SCHEMA), f"eq_raw.{jobs.SENSOR_COUNTS}", root)
    publish_table(dim, f"eq_raw.{jobs.SENSOR_REFERENCE}", root)
    jobs.build_reports(spark, root, raw_db="eq_raw", report_db="eq_days", n=2)
    jobs.build_reports(spark, root, raw_db="eq_raw", report_db="eq_scans", n=2, one_scan=False)
    assert spark.catalog.tableExists(f"eq_days.{jobs.DAY_TOTALS}")
    assert not spark.catalog.tableExists(f"eq_scans.{jobs.DAY_TOTALS}")
    for name in (jobs.TOP_BY_DAY, jobs.TOP_BY_MONTH, jobs.DECLINES, jobs.GROWTH):
        a = spark.table(f"eq_days.{name}")
        b = spark.table(f"eq_scans.{name}")
        assert a.dtypes == b.dtypes, name
        got, want = (sorted(map(tuple, t.collect()), key=str) for t in (a, b))
        assert got == want, name
    decline = {r.sensor_id: r for r in spark.table(f"eq_days.{jobs.DECLINES}").collect()}
    assert set(decline) == {1, 2, 4}
    assert (decline[1].count_2019, decline[1].count_2022) == (200, 50)
    assert decline[4].count_2019 is None and decline[4].decline_percent is None


def _land(spark, rows, name):
    land = local(scratch_path(spark, name))
    os.makedirs(land)
    with open(os.path.join(land, "counts.csv"), "w") as f:
        f.write("ID,Date_Time,Sensor_ID,Sensor_Name,Hourly_Counts\n")
        for r in rows:
            f.write(",".join(f'"{v}"' for v in r) + "\n")
    return land


def test_incremental_day_totals_equal_full_rebuild(spark):
    """Landing batches by month and refreshing only their months of the day
    totals gives the table a full rebuild from the stored counts gives, and
    reports built from it read no raw count and prune months."""
    from tests.helpers import plan_text

    first = [
        ("1", "November 01, 2018 12:00:00 AM", "1", "A", "100"),
        ("2", "November 02, 2018 01:00:00 AM", "1", "A", "5"),
        ("3", "March 03, 2019 10:00:00 AM", "2", "B", "20"),
        ("4", "November 05, 2021 09:00:00 AM", "1", "A", "50"),
        ("5", "November 05, 2021 10:00:00 AM", "2", "B", "30"),
        ("8", "November 03, 2018 01:00:00 AM", "1", "A", "-5"),  # fails non_negative
        ("9", "March 04, 2019 02:00:00 AM", "1500", "Q", "3"),  # fails in_range, kept
    ]
    # part of November 2018 again with other counts, plus a new month; the other
    # rows of that month, March 2019 and November 2021 must stay as they are
    second = [
        ("1", "November 01, 2018 12:00:00 AM", "1", "A", "70"),
        ("6", "November 01, 2018 03:00:00 AM", "3", "C", "9"),
        ("7", "January 10, 2022 08:00:00 AM", "3", "C", "4"),
        ("8", "November 03, 2018 01:00:00 AM", "1", "A", "5"),
        ("4", "January 11, 2022 08:00:00 AM", "3", "C", "6"),  # an id of another month
    ]
    raw_db, report_db, full_db = "inc_raw", "inc_report", "inc_full"
    counts_at = scratch_path(spark, "inc-counts")
    totals_at = scratch_path(spark, "inc-totals")
    failures_at, twice_at = scratch_path(spark, "inc-failures"), scratch_path(spark, "inc-twice")
    for batch in (_land(spark, first, "b1"), _land(spark, second, "b2")):
        months = jobs.merge_counts(spark, jobs.land_counts(spark, batch), counts_at, raw_db)
        jobs.refresh_day_totals(spark, months, totals_at, report_db)
        jobs.refresh_check_failures(spark, months, failures_at, report_db)
        jobs.refresh_duplicate_ids(spark, months, twice_at, raw_db, report_db)
    counts = spark.table(f"{raw_db}.{jobs.SENSOR_COUNTS}")
    jobs.refresh_day_totals(spark, counts, scratch_path(spark, "full-totals"), full_db, full=True)
    inc = sorted(map(tuple, spark.table(f"{report_db}.{jobs.DAY_TOTALS}").collect()), key=str)
    full = sorted(map(tuple, spark.table(f"{full_db}.{jobs.DAY_TOTALS}").collect()), key=str)
    assert inc == full
    by_day = {(str(r[0]), r[2]): (r[3], r[4]) for r in inc}
    assert by_day[("2018-11-01", 1)] == (70, 1)  # replaced, not added
    assert by_day[("2018-11-02", 1)] == (5, 1)  # not in the batch: kept
    assert by_day[("2019-03-03", 2)] == (20, 1)  # untouched month kept

    from countlens.schemas import SENSOR_REFERENCE
    from countlens.sources.tables import publish_table

    dim = spark.createDataFrame(
        [(k, name, f"S{k}", None, None, "Outdoor", "A", None, None, -37.8, 144.9, None)
         for k, name in ((1, "Town Hall"), (2, "Bridge"), (3, "Station"))],
        SENSOR_REFERENCE,
    )
    root = scratch_path(spark, "inc-mart")
    publish_table(dim, f"{raw_db}.{jobs.SENSOR_REFERENCE}", root)
    periods = (("2018-11-01", "2019-11-01"), ("2021-11-01", "2022-11-01"))
    jobs.build_reports(spark, root, raw_db, report_db, n=2, decline_periods=periods,
                       growth_periods=periods, day_totals_table=f"{report_db}.{jobs.DAY_TOTALS}")
    jobs.build_reports(spark, root, raw_db, "inc_scans", n=2, decline_periods=periods,
                       growth_periods=periods, one_scan=False)
    with pytest.raises(ValueError, match="refresh_day_totals"):
        jobs.build_reports(spark, root, raw_db, report_db, n=2, decline_periods=periods,
                           growth_periods=periods)  # would repoint the maintained table
    for name in (jobs.TOP_BY_DAY, jobs.TOP_BY_MONTH, jobs.DECLINES, jobs.GROWTH):
        a = sorted(map(tuple, spark.table(f"{report_db}.{name}").collect()), key=str)
        b = sorted(map(tuple, spark.table(f"inc_scans.{name}").collect()), key=str)
        assert a == b, name

    def checks(**kw):
        return {
            (r.table_name, r.column_name, r.check_name): r.failures
            for r in jobs.data_tests(spark, raw_db, report_db, n=2, **kw).collect()
        }

    kept = checks(check_failures_table=f"{report_db}.{jobs.CHECK_FAILURES}")
    assert kept == checks()
    assert kept == checks(
        check_failures_table=f"{report_db}.{jobs.CHECK_FAILURES}",
        duplicate_ids_table=f"{report_db}.{jobs.DUPLICATE_IDS}",
    )
    assert kept[("sensor_counts", "id", "unique")] == 1  # id 4, in two months
    from countlens.operators.checks import ChecksFailed

    with pytest.raises(ChecksFailed, match="sensor_counts.id unique: 1") as failed:
        jobs.require_data_tests(jobs.data_tests(spark, raw_db, report_db, n=2))
    assert ("sensor_counts", "sensor_id", "in_range", 1) in failed.value.failed
    assert kept[("sensor_counts", "hourly_count", "non_negative")] == 0  # re-landed away
    assert kept[("sensor_counts", "sensor_id", "in_range")] == 1  # untouched month

    from countlens.plans.reports import growth_report
    days = spark.table(f"{report_db}.{jobs.DAY_TOTALS}")
    plan = plan_text(growth_report(days, dim, *periods, ts_col="day_text", value_col="total",
                                   rows_col="n_rows", month_col=jobs.MONTH_COL))
    assert "PartitionFilters: [" in plan and "year_month" in plan
    assert os.path.basename(counts_at) not in plan  # the raw counts are never read
    assert os.path.basename(totals_at) in plan


def test_unparsed_rows_are_kept_per_source_file(spark):
    """With on_bad="null", rows whose time does not parse are keyed by their
    file: a second file keeps the first file's such rows, re-landing a file
    replaces only its own, and reports from the day totals still equal the
    per-report scans (the NULL day of one sensor sums over files)."""
    from countlens.schemas import SENSOR_REFERENCE
    from countlens.sources.tables import publish_table

    a = _land(spark, [("1", "junk", "1", "A", "5"),
                      ("2", "November 05, 2021 09:00:00 AM", "1", "A", "50")], "ua")
    b = _land(spark, [("3", "also junk", "1", "A", "7"),
                      ("4", "December 05, 2021 09:00:00 AM", "2", "B", "30")], "ub")
    raw_db, report_db = "unp_raw", "unp_report"
    counts_at, totals_at = scratch_path(spark, "unp-counts"), scratch_path(spark, "unp-totals")
    for batch in (a, b, a):  # the first file lands twice
        months = jobs.merge_counts(spark, jobs.land_counts(spark, batch, on_bad="null"), counts_at, raw_db)
        jobs.refresh_day_totals(spark, months, totals_at, report_db)
    counts = spark.table(f"{raw_db}.{jobs.SENSOR_COUNTS}")
    assert sorted(r.id for r in counts.collect()) == [1, 2, 3, 4]
    months = {r.year_month for r in counts.collect()}
    assert len([m for m in months if m.startswith(jobs.UNPARSED_PREFIX)]) == 2

    dim = spark.createDataFrame(
        [(k, name, f"S{k}", None, None, "Outdoor", "A", None, None, -37.8, 144.9, None)
         for k, name in ((1, "Town Hall"), (2, "Bridge"))],
        SENSOR_REFERENCE,
    )
    root = scratch_path(spark, "unp-mart")
    publish_table(dim, f"{raw_db}.{jobs.SENSOR_REFERENCE}", root)
    periods = (("2020-11-01", "2021-11-01"), ("2021-11-01", "2022-11-01"))
    kw = dict(n=2, decline_periods=periods, growth_periods=periods)
    jobs.build_reports(spark, root, raw_db, report_db,
                       day_totals_table=f"{report_db}.{jobs.DAY_TOTALS}", **kw)
    jobs.build_reports(spark, root, raw_db, "unp_scans", one_scan=False, **kw)
    for name in (jobs.TOP_BY_DAY, jobs.TOP_BY_MONTH, jobs.DECLINES, jobs.GROWTH):
        got = sorted(map(tuple, spark.table(f"{report_db}.{name}").collect()), key=str)
        want = sorted(map(tuple, spark.table(f"unp_scans.{name}").collect()), key=str)
        assert got == want, name
    undated = [r for r in spark.table(f"{report_db}.{jobs.TOP_BY_DAY}").collect() if r.date is None]
    assert [(r.rank, r.sensor_id, r.daily_count) for r in undated] == [(1, 1, 12)]


def test_malformed_times_count_as_their_text_does(spark):
    """A clock that is no time of day, and a day that is no date: the change reports
    give one answer whether from raw scans, one scan, or kept day totals."""
    from countlens.schemas import SENSOR_COUNTS as SCHEMA
    from countlens.sources.tables import publish_table

    rows = [
        (1, "2019-05-02T99:00:00", 1, "A", 7), (2, "2019-05-02T10:00:00", 1, "A", 10),
        (3, "2022-02-31", 1, "A", 4), (4, "2022-02-28T00:00:00", 1, "A", 2), (5, "2019", 2, "B", 1),
        (6, "2019-05-40T00:00:00", 2, "B", 3), (7, "2022-01-01T00:00:00", 2, "B", 5), (8, "", 2, "B", 9),
    ]
    counts = spark.createDataFrame(rows, SCHEMA)
    dim = spark.createDataFrame([(1, "X"), (2, "Y")], "location_id int, sensor_description string")
    root = scratch_path(spark, "mal")
    publish_table(counts, f"mal_raw.{jobs.SENSOR_COUNTS}", root)
    publish_table(dim, f"mal_raw.{jobs.SENSOR_REFERENCE}", root)
    publish_table(dim, f"malm_raw.{jobs.SENSOR_REFERENCE}", root)
    from pyspark.sql import functions as F

    batch = counts.withColumn(jobs.MONTH_COL, F.substring("date_time", 1, 7))
    months = jobs.merge_counts(spark, batch.filter("date_time <> ''"), scratch_path(spark, "malc"), "malm_raw")
    totals = jobs.refresh_day_totals(spark, months, scratch_path(spark, "malt"), "malm")
    jobs.build_reports(spark, root, "mal_raw", "mal_scans", one_scan=False)
    jobs.build_reports(spark, root, "mal_raw", "mal_days")
    jobs.build_reports(spark, root, "malm_raw", "malm", day_totals_table=totals)
    got = [sorted(map(tuple, spark.table(f"{db}.{jobs.DECLINES}").collect())) for db in ("mal_scans", "mal_days", "malm")]
    assert got[0] == got[1] == got[2] == [(1, "X", 17, 6, 11, 11 / 17 * 100.0), (2, "Y", 4, 5, -1, -25.0)]


def test_month_files_are_few_sorted_and_split_when_hot(spark):
    """Many input tasks and unordered times: files follow the data, each sorted by time."""
    import glob

    from pyspark.sql import functions as F

    n = 20_000
    rows = spark.range(0, n, 1, 40).select(
        F.col("id"),
        F.concat(
            F.lit("2020-"),
            F.lpad(F.when(F.col("id") % 2 == 0, F.lit("3")).otherwise((F.pmod(F.xxhash64("id"), F.lit(12)) + 1).cast("string")), 2, "0"),
            F.lit("-01T00:"), F.lpad((F.pmod(F.xxhash64("id"), F.lit(60))).cast("string"), 2, "0"), F.lit(":00"),
        ).alias("date_time"),
        F.lit(1).alias("sensor_id"), F.lit("A" * 50).alias("sensor_name"), F.lit(1).alias("hourly_count"),
    )
    batch = rows.withColumn(jobs.MONTH_COL, F.substring("date_time", 1, 7))
    location = scratch_path(spark, "files")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        jobs.merge_counts(spark, batch, location, "files_raw")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", None) == before
    files = {m: glob.glob(f"{local(location)}/year_month=2020-{m:02d}/*.parquet") for m in range(1, 13)}
    counts = {m: len(f) for m, f in files.items()}
    # 40 tasks hold rows of every month; files follow the bytes instead, and the hot month is split
    assert sum(counts.values()) < 100 and max(counts.values()) < 20 and counts[3] > 2, counts
    import pyarrow.parquet as pq

    for listed in files.values():
        for f in listed:
            times = pq.ParquetFile(f).read(["date_time"]).column(0).to_pylist()
            assert times == sorted(times)
    assert spark.table(f"files_raw.{jobs.SENSOR_COUNTS}").count() == n


def test_ordered_reports_and_narrow_types(spark):
    from countlens.schemas import SENSOR_COUNTS as SCHEMA
    from countlens.sources.tables import publish_table

    rows = [(i, f"20{18 + i % 5}-11-{1 + i % 3:02d}T01:00:00", i % 4, "A", 10 * (i % 2) + 5) for i in range(80)]
    root = scratch_path(spark, "ord")
    publish_table(spark.createDataFrame(rows, SCHEMA), f"ord_raw.{jobs.SENSOR_COUNTS}", root)
    dim = spark.createDataFrame([(1, "X")], "location_id int, sensor_description string")
    publish_table(dim, f"ord_raw.{jobs.SENSOR_REFERENCE}", root)
    jobs.build_reports(spark, root, "ord_raw", "ord", n=3, ordered=True, count_type="int")
    daily = spark.table(f"ord.{jobs.TOP_BY_DAY}").coalesce(1).collect()
    key = [(r.date, -r["rank"]) for r in daily]
    assert key == sorted(key, reverse=True)
    for name, column in ((jobs.TOP_BY_DAY, "daily_count"), (jobs.TOP_BY_MONTH, "monthly_count"), (jobs.GROWTH, "growth")):
        assert dict(spark.table(f"ord.{name}").dtypes)[column] == "int"
    from countlens.plans.reports import decline_report

    counts = spark.createDataFrame(
        [(t, k, 10 if t < "2020" else 5) for k in (3, 1, 2) for t in ("2019-01-01", "2022-01-01")], "date_time string, sensor_id int, hourly_count int"
    )
    got = decline_report(counts, dim).collect()
    assert [r.sensor_id for r in got] == [1, 2, 3]  # equal percents by sensor


def test_duplicate_ids_are_dealt_out_by_id_alone(spark, monkeypatch):
    """Of all rows only the ids are dealt out, once to count them and once to find the months of the repeated."""
    land = _land(spark, [(str(i % 30), f"March {1 + i % 9:02d}, 2019 10:00:00 AM", "1", "A", "5") for i in range(40)], "twice")
    months = jobs.merge_counts(spark, jobs.land_counts(spark, land), scratch_path(spark, "twice-counts"), "twice_raw")
    seen, write = [], jobs.overwrite_partitions
    monkeypatch.setattr(jobs, "overwrite_partitions", lambda df, *a, **k: (seen.append(df), write(df, *a, **k)))
    name = jobs.refresh_duplicate_ids(spark, months, scratch_path(spark, "twice"), "twice_raw", "twice_report")
    assert sorted(r["id"] for r in spark.table(name).filter("id is not null").collect()) == list(range(10))
    dealt = [x for x in plan_text(seen[0]).splitlines() if x.startswith("Arguments: hashpartitioning(") and "id#" in x]
    assert len(dealt) == 2 and not any("year_month" in x for x in dealt), dealt


def _hourly(spark, days, sensors, hours):
    rows = [
        (i, f"2019-{1 + d // 28:02d}-{1 + d % 28:02d}T{'99' if i % 8 == 2 else f'{h:02d}'}:00:00", s, f"S{s}", i % 7)
        for i, (d, s, h) in enumerate((d, s, h) for d in range(days) for s in range(sensors) for h in range(hours))
    ]
    rows += [(None, None, None, None, None), (1, "2019-01-05T10:00:00", None, "S", None), rows[0], rows[0]]
    return spark.createDataFrame(rows, "id long, date_time string, sensor_id int, sensor_name string, hourly_count int")


def _tasks(df):
    """Rows of each task that groups ``df``, as its plan deals them out."""
    return df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()


def test_groups_near_as_many_as_rows_are_dealt_to_bounded_tasks(spark, monkeypatch):
    from countlens.operators import periods

    keys = ["date_time", "sensor_id"]
    single, many = _hourly(spark, 50, 20, 1), _hourly(spark, 10, 2, 24).withColumn("date_time", F.substring("date_time", 1, 7))
    monkeypatch.setattr(periods, "ROWS_PER_TASK", 100)
    dealt = periods.dealt_by_group(single, keys)
    sizes = _tasks(dealt)
    assert len(sizes) == 11 and sum(sizes) == single.count() and max(sizes) < 200
    plan = plan_text(dealt.groupBy(*keys).count())
    assert plan.split("(1)")[0].count("Exchange") == 1  # the groupBy takes this shuffle for its own
    assert periods.dealt_by_group(many, keys) is many  # a sum per task leaves few rows to shuffle
    assert len(_tasks(periods.dealt_by_group(many, keys, summed=True))) == 5  # unless they are sums already
    monkeypatch.setattr(periods, "ROWS_PER_TASK", 1004)
    assert periods.dealt_by_group(single, keys) is single


def test_day_totals_and_reports_are_equal_when_dealt(spark, monkeypatch):
    """Null, repeated and malformed rows: totals and rankings of dealt rows are those of the plain plan."""
    from countlens.operators import periods

    counts = _hourly(spark, 40, 9, 1)
    args = ("date_time", "sensor_id", "hourly_count")
    plain = periods.day_totals(counts, *args)
    wants = sorted(map(tuple, plain.collect()), key=str)
    once = sorted(map(tuple, jobs._one_row_per_day(plain).collect()), key=str)
    monkeypatch.setattr(periods, "ROWS_PER_TASK", 25)
    dealt = periods.dealt_day_totals(counts, *args)
    assert "REPARTITION_BY_NUM" in plan_text(dealt) and dealt.schema == plain.schema
    assert sorted(map(tuple, dealt.collect()), key=str) == wants
    again = jobs._one_row_per_day(dealt)
    assert "REPARTITION_BY_NUM" in plan_text(again)
    assert sorted(map(tuple, again.collect()), key=str) == once

    batch = counts.withColumn(jobs.MONTH_COL, F.substring("date_time", 1, 7)).filter("date_time is not null")
    months = jobs.merge_counts(spark, batch, scratch_path(spark, "dealt-counts"), "dealt_raw")
    name = jobs.refresh_day_totals(spark, months, scratch_path(spark, "dealt-totals"), "dealt")
    got = spark.table(name)
    assert sorted(map(tuple, got.drop(jobs.MONTH_COL).select(plain.columns).collect()), key=str) == [
        w for w in wants if w[1] is not None
    ]


def test_stored_rows_of_a_batch_are_not_shuffled_by_month(spark):
    batch = _hourly(spark, 40, 9, 1).withColumn(jobs.MONTH_COL, F.substring("date_time", 1, 7)).filter("date_time is not null")
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        months = jobs.merge_counts(spark, batch, scratch_path(spark, "by-month-counts"), "by_month_raw")
        plan = plan_text(months)
        assert months.count() == batch.count()
    finally:
        spark.conf.set(key, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
