"""Plan assertions: pushdown, pruning, top-k limit before the shuffle,
one scan for the change reports, and plans that run nothing until asked."""

import pytest

from countlens.plans import testbed as tb
from countlens.plans.reports import decline_report, top_n_by_day
from tests.helpers import plan_text

SF = "/root/testdata/sf0.001"
KW = dict(ts_col="l_shipdate", id_col="l_suppkey", value_col="l_quantity",
          dim_key="s_suppkey", label_col="s_name")


@pytest.fixture(scope="module")
def tables(spark):
    return tb.table(spark, SF, "lineitem"), tb.table(spark, SF, "supplier")


def test_top_n_plan(tables):
    li, su = tables
    plan = plan_text(top_n_by_day(li, su, **KW))
    assert "WindowGroupLimit" in plan and "Partial" in plan  # limit before the day shuffle
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<s_suppkey:bigint,s_name:string>" in plan
    assert "BroadcastHashJoin LeftOuter BuildRight" in plan
    assert "partial_sum" in plan


def test_change_report_single_scan_with_pushdown(tables):
    li, su = tables
    plan = plan_text(decline_report(li, su, base=tb.BASE, current=tb.CURRENT, **KW))
    assert plan.count("lineitem.parquet") == 1
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(l_shipdate" in plan
    assert "IsNotNull(l_suppkey)" in plan


def test_a_dimension_above_the_threshold_is_not_broadcast(spark, tables):
    """Also when its files were replaced by larger ones after it was first read."""
    from pyspark.sql import functions as F

    from countlens.session import scratch_path
    from countlens.sources import overwrite_path

    li, _ = tables
    path = scratch_path(spark, "dim-grows")

    def report(rows):
        dim = spark.range(rows).select(F.col("id").alias("s_suppkey"), F.sha2(F.col("id").cast("string"), 512).alias("s_name"))
        overwrite_path(dim, path)
        df = top_n_by_day(li, spark.read.parquet(path), **KW)
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50k")
    try:
        assert "BroadcastHashJoin" in report(100)
        assert "BroadcastHashJoin" not in report(5000)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_building_reports_runs_no_job(spark, tables):
    from countlens.plans.reports import growth_report, top_n_by_month

    li, su = tables
    tracker, group = spark.sparkContext.statusTracker(), "building"
    spark.sparkContext.setJobGroup(group, group)
    try:
        daily = top_n_by_day(li, su, ordered=True, **KW)
        top_n_by_month(daily, su, dim_key="s_suppkey", label_col="s_name")
        decline_report(li, su, base=tb.BASE, current=tb.CURRENT, **KW)
        growth_report(li, su, previous=tb.CURRENT, last=tb.LAST, **KW)
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_long_rankings_never_gather_a_period(spark):
    """Beyond Spark's own limit, rows are ranked by a range sort: no window over the period's rows."""
    from pyspark.sql import functions as F

    from countlens.operators.ranking import rank_within

    rows = spark.range(9000).select(F.lit("p").alias("p"), "id", (F.col("id") % 700).alias("v"))
    got = rank_within(rows, "p", "id", "v", 1500)
    want = sorted(((-(i % 700), i) for i in range(9000)))[:1500]
    assert sorted((r["rank"], r["id"]) for r in got.collect()) == [(k + 1, i) for k, (_, i) in enumerate(want)]
    plan = plan_text(got)
    windows = [line for line in plan.splitlines() if "Window" in line and "windowspecdefinition" in line]
    assert all("__share" in line or "__rows" in line for line in windows) and "row_number" not in plan


def test_checks_plan_pushes_nothing_to_driver(spark):
    plan = plan_text(tb.q_sensor_counts_data_tests(spark, SF))
    assert "partial_count" in plan
    assert "CollectLimit" not in plan


def test_size_bound_rows_and_bytes(spark):
    from pyspark.sql import functions as F

    from countlens.operators.enrich import within_bounds

    df = spark.range(100).select(F.col("id"), F.repeat(F.lit("x"), 100).alias("label"))
    assert within_bounds(df, 100, None)
    assert not within_bounds(df, 99, None)
    # 100 rows * (8 + 100 + 8) bytes
    assert within_bounds(df, 1000, 11_600)
    assert not within_bounds(df, 1000, 11_599)


def test_month_partition_pruning(spark):
    from pyspark.sql import functions as F

    from countlens.session import scratch_path
    from countlens.sources import overwrite_partitions, register_table

    rows = [(f"2019-{m:02d}-15T10:00:00", 1, m) for m in range(1, 13)] + [
        (f"2021-{m:02d}-15T10:00:00", 1, 2 * m) for m in range(1, 13)
    ]
    df = spark.createDataFrame(rows, "date_time string, sensor_id int, hourly_count int")
    df = df.withColumn("year_month", F.substring("date_time", 1, 7))
    loc = scratch_path(spark, "pruned")
    register_table(spark, "t_pruned", df.schema, loc, partition_by=["year_month"])
    overwrite_partitions(df, "t_pruned")
    dim = spark.createDataFrame([(1, "A")], "location_id int, sensor_description string")
    counts = spark.table("t_pruned")
    rep = decline_report(
        counts, dim, ("2019-03-01", "2019-05-01"), ("2021-03-01", "2021-05-01"), month_col="year_month"
    )
    plan = plan_text(rep)
    assert "PartitionFilters: [(((year_month" in plan
    assert "2019-03" in plan and "2021-05" in plan
    r = rep.first()
    assert (r.count_2019, r.count_2022) == (3 + 4, 6 + 8)
    same = decline_report(counts, dim, ("2019-03-01", "2019-05-01"), ("2021-03-01", "2021-05-01"))
    assert same.first().asDict() == r.asDict()


def test_size_follows_file_content(spark):
    from countlens.operators import enrich
    from countlens.session import scratch_path
    from countlens.sources import overwrite_path

    p = scratch_path(spark, "dimver")
    overwrite_path(spark.range(10), p)
    assert enrich.measured_size(spark.read.parquet(p)) == (10, 80)
    overwrite_path(spark.range(20), p)  # new content, new file names
    assert enrich.measured_size(spark.read.parquet(p)) == (20, 160)
