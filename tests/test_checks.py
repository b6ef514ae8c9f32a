"""Data-quality fixture of FIXTURES.md section 3."""

import pytest
from pyspark.sql import functions as F

from countlens.operators import checks as ck
from tests.helpers import plan_text

COUNTS = [
    (1, "2022-01-01T00:00:00", 1, "A", 10),
    (1, "2022-01-01T01:00:00", 1, "A", -5),
    (2, "2022-01-01 02:00:00", -3, "B", 0),
    (3, None, 1000, None, None),
    (None, "2022-01-01T03:00:00Z", 999, "C", 1),
    (4, "2022-01-01T04:00:00.123+10:00", 0, "D", 2),
]
COUNTS_SCHEMA = "id int, date_time string, sensor_id int, sensor_name string, hourly_count int"

REFERENCE = [
    (1, "Town Hall", "2009-05-01", "Outdoor", "A", "North", "South", -37.8, 144.9),
    (1, "Bridge", "01/05/2009", "Outdoor Blix", "A", "Up", None, -37.8, None),
    (2, None, None, "Underground", "R", "In", "Out", None, 144.9),
]
REFERENCE_SCHEMA = (
    "location_id int, sensor_description string, installation_date string, "
    "location_type string, status string, direction_1 string, direction_2 string, "
    "latitude double, longitude double"
)


def results(df):
    return {(r.column_name, r.check_name): r.failures for r in df.collect()}


@pytest.fixture(scope="module")
def counts(spark):
    return spark.createDataFrame(COUNTS, COUNTS_SCHEMA)


@pytest.fixture(scope="module")
def reference(spark):
    return spark.createDataFrame(REFERENCE, REFERENCE_SCHEMA)


def test_sensor_counts_checks(counts):
    got = results(ck.run_checks(counts, ck.sensor_counts_checks(), "sensor_counts"))
    assert got == {
        ("id", "unique"): 1,
        ("id", "not_null"): 1,
        ("date_time", "not_null"): 1,
        ("date_time", "is_iso_format"): 1,
        ("sensor_id", "not_null"): 0,
        ("sensor_name", "not_null"): 1,
        ("hourly_count", "not_null"): 1,
        ("hourly_count", "non_negative"): 1,
        ("sensor_id", "in_range"): 2,
    }


def test_iso_offset_required(counts):
    got = results(ck.run_checks(counts, [ck.is_iso_format("date_time", require_offset=True)]))
    assert got == {("date_time", "is_iso_format"): 3}


def test_range_as_literally_written_never_fails(counts):
    literal = ck.custom("sensor_id", "range_and", lambda c: (c < 0) & (c >= 1000))
    assert results(ck.run_checks(counts, [literal])) == {("sensor_id", "range_and"): 0}


def test_reference_checks(reference):
    got = results(ck.run_checks(reference, ck.sensor_reference_checks(), "sensor_reference_data"))
    assert got == {
        ("location_id", "not_null"): 0,
        ("location_id", "unique"): 1,
        ("sensor_description", "not_null"): 1,
        ("installation_date", "is_date_format"): 1,
        ("location_type", "not_null"): 0,
        ("location_type", "accepted_values"): 1,
        ("status", "not_null"): 0,
        ("status", "accepted_values"): 1,
        ("direction_1", "accepted_values"): 1,
        ("direction_2", "accepted_values"): 0,
        ("latitude", "not_null"): 1,
        ("longitude", "not_null"): 1,
    }


def test_rank_range_ignores_null(spark):
    df = spark.createDataFrame(
        [("2020-01-01", 1, 1, 5), ("2020-01-01", 11, 2, 4), ("2020-01-01", None, 3, 3)],
        "date string, rank int, sensor_id int, daily_count bigint",
    )
    got = results(ck.run_checks(df, ck.top_n_by_day_checks(10)))
    assert got[("rank", "rank_range")] == 1
    assert got[("rank", "not_null")] == 1


def test_violations(counts):
    dup = ck.violations(counts, ck.unique("id")).collect()
    assert [(r.value, r.n_records) for r in dup] == [(1, 2)]
    neg = ck.violations(counts, ck.non_negative("hourly_count")).collect()
    assert [r.hourly_count for r in neg] == [-5]


def test_all_pass_and_empty(spark, counts):
    ok = ck.run_checks(counts.filter(F.col("id") == 4), [ck.not_null("id"), ck.unique("id")])
    assert ok.agg(ck.all_pass(ok).alias("ok")).first().ok is True
    assert ck.run_checks(counts, []).count() == 0


def test_row_checks_share_one_scan(counts):
    df = ck.run_checks(counts, [ck.not_null("id"), ck.non_negative("hourly_count")])
    plan = plan_text(df, "simple")
    assert plan.count("Scan ExistingRDD") + plan.count("Scan parquet") <= 1


def test_row_check_failures_per_group_add_up(spark):
    df = spark.createDataFrame(
        [("2022-01", 1, -1), ("2022-01", None, 2), ("2022-02", 3, -4), ("2022-02", 4, None)],
        "m string, k int, v int",
    )
    checks = [ck.not_null("k"), ck.non_negative("v")]
    per = {(r.m, r.check_name): r.failures for r in ck.run_checks(df, checks, "t", by=["m"]).collect()}
    assert per == {("2022-01", "not_null"): 1, ("2022-01", "non_negative"): 1,
                   ("2022-02", "not_null"): 0, ("2022-02", "non_negative"): 1}
    whole = {r.check_name: r.failures for r in ck.run_checks(df, checks, "t").collect()}
    assert whole == {"not_null": 1, "non_negative": 2}
    with pytest.raises(ValueError):
        ck.run_checks(df, [ck.unique("k")], "t", by=["m"])


def test_failing_rows_evaluate_each_check_once(spark):
    """No array is built and searched per row, and a check is not evaluated again to drop sound rows."""
    rows = [(1, "2019-03-01T10:00:00", 5), (None, "bad", -1), (3, None, None), (4, "bad", 5000)]
    df = spark.createDataFrame(rows, "id int, date_time string, n int")
    checks = [ck.not_null("id"), ck.is_iso_format("date_time"), ck.non_negative("n"), ck.in_range("n", 0, 1000)]
    got = ck.failing_rows(df, checks, ["id", "n"])
    plan = plan_text(got, "simple")
    assert plan.count("RLIKE") == 1 and "lambdafunction" not in plan
    want = [(r.id, r.n, c.column, c.name) for c in checks for r in ck.violations(df, c).collect()]
    assert len(want) == 6 and sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
