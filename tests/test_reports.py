"""Report fixture of FIXTURES.md section 2: hand-checked expected rows."""

import pytest

from countlens.operators.periods import period_total, present_in_both
from countlens.plans.reports import decline_report, growth_report, top_n_by_day, top_n_by_month
from countlens.sources.files import counts_from_raw

RAW = [
    ("1", "November 01, 2018 12:00:00 AM", "1", "A", "100"),
    ("2", "October 31, 2019 11:00:00 PM", "1", "A", "100"),
    ("3", "November 01, 2019 12:00:00 AM", "1", "A", "7"),
    ("4", "November 05, 2020 09:00:00 AM", "1", "A", "40"),
    ("5", "November 05, 2021 09:00:00 AM", "1", "A", "50"),
    ("6", "November 05, 2021 10:00:00 AM", "2", "B", "30"),
    ("7", "November 05, 2021 11:00:00 AM", "2", "B", "20"),
    ("8", "November 05, 2020 10:00:00 AM", "3", "C", "0"),
    ("9", "November 05, 2021 10:00:00 AM", "3", "C", "5"),
    ("10", "June 01, 2019 10:00:00 AM", "2", "B", "200"),
    ("11", "November 01, 2022 12:00:00 AM", "1", "A", "999"),
    ("12", "November 05, 2021 12:00:00 PM", "9", "Z", "60"),
]
RAW_SCHEMA = "ID string, Date_Time string, Sensor_ID string, Sensor_Name string, Hourly_Counts string"


@pytest.fixture(scope="module")
def counts(spark):
    return counts_from_raw(spark.createDataFrame(RAW, RAW_SCHEMA))


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [(1, "Town Hall"), (2, "Bridge"), (3, "Station")],
        "location_id int, sensor_description string",
    )


def test_ingest_parses_twelve_hour_clock(counts):
    got = {r.id: r.date_time for r in counts.collect()}
    assert got[1] == "2018-11-01T00:00:00"
    assert got[2] == "2019-10-31T23:00:00"
    assert got[12] == "2021-11-05T12:00:00"
    assert dict(counts.dtypes) == {
        "id": "bigint", "date_time": "string", "sensor_id": "int",
        "sensor_name": "string", "hourly_count": "int",
    }


def test_top_2_per_day(counts, dim):
    rows = top_n_by_day(counts, dim, n=2, ordered=True).collect()
    assert [tuple(r) for r in rows] == [
        ("2022-11-01", 1, 1, "Town Hall", 999),
        ("2021-11-05", 1, 9, None, 60),
        ("2021-11-05", 2, 1, "Town Hall", 50),
        ("2020-11-05", 1, 1, "Town Hall", 40),
        ("2020-11-05", 2, 3, "Station", 0),
        ("2019-11-01", 1, 1, "Town Hall", 7),
        ("2019-10-31", 1, 1, "Town Hall", 100),
        ("2019-06-01", 1, 2, "Bridge", 200),
        ("2018-11-01", 1, 1, "Town Hall", 100),
    ]


def test_top_2_per_month_from_daily_report(counts, dim):
    daily = top_n_by_day(counts, dim, n=2)
    rows = top_n_by_month(daily, dim, n=2, ordered=True).collect()
    assert [(r.year_month, r.rank, r.sensor_id, r.monthly_count) for r in rows] == [
        ("2022-11", 1, 1, 999),
        ("2021-11", 1, 9, 60),
        ("2021-11", 2, 1, 50),
        ("2020-11", 1, 1, 40),
        ("2020-11", 2, 3, 0),
        ("2019-11", 1, 1, 7),
        ("2019-10", 1, 1, 100),
        ("2019-06", 1, 2, 200),
        ("2018-11", 1, 1, 100),
    ]


def test_decline(counts, dim):
    rows = decline_report(counts, dim).collect()
    got = sorted((r.sensor_id, r.count_2019, r.count_2022, r.decline, r.decline_percent) for r in rows)
    assert got == [(1, 200, 50, 150, 75.0), (2, 200, 50, 150, 75.0)]
    assert {r.location_name for r in rows} == {"Town Hall", "Bridge"}


def test_growth_zero_base_is_null(counts, dim):
    rows = growth_report(counts, dim).collect()
    got = sorted(
        (r.sensor_id, r.count_previous_year, r.count_last_year, r.growth, r.growth_percent)
        for r in rows
    )
    assert got == [(1, 40, 50, 10, 25.0), (3, 0, 5, 5, None)]
    # ordered by percent descending, NULL last
    assert [r.sensor_id for r in rows] == [1, 3]


def test_half_open_bounds(counts):
    rows = period_total(
        counts, "date_time", "2018-11-01", "2019-11-01", "sensor_id", "hourly_count", "t"
    ).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 200), (2, 200)]


def test_one_scan_equals_join_with_nulls_and_overlap(spark):
    df = spark.createDataFrame(
        [
            ("2020-01-05", 1, None), ("2020-06-05", 1, None),  # all-NULL values, both periods
            ("2020-01-05", None, 5), ("2020-06-05", None, 5),  # NULL key
            ("2020-03-01", 2, 4),  # in the overlap of both periods
            ("2020-01-02", 3, 1),  # base only
        ],
        "ts string, k int, v int",
    )
    base, cur = ("2020-01-01", "2020-04-01"), ("2020-03-01", "2020-07-01")
    one = present_in_both(df, "ts", base, cur, "k", "v", "b", "c").select("k", "b", "c")
    a = period_total(df, "ts", *base, "k", "v", "b")
    b = period_total(df, "ts", *cur, "k", "v", "c")
    two = a.join(b, "k", "inner")
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)
    assert sorted(map(tuple, one.collect()), key=str) == [(1, None, None), (2, 4, 4)]


def test_count_type_int_gives_declared_types(counts, dim):
    df = top_n_by_day(counts, dim, n=2, count_type="int", id_type="int")
    assert dict(df.dtypes)["daily_count"] == "int"
    assert dict(df.dtypes)["sensor_id"] == "int"


def test_null_dates_form_one_period(spark, dim):
    df = spark.createDataFrame(
        [(1, "junk", 1, "A", 5), (2, "also junk", 2, "B", 7), (3, "2020-01-01T01:00:00", 1, "A", 1)],
        "id int, date_time string, sensor_id int, sensor_name string, hourly_count int",
    )
    rows = top_n_by_day(df, dim, n=10).collect()
    nulls = sorted((r.rank, r.sensor_id, r.daily_count) for r in rows if r.date is None)
    assert nulls == [(1, 2, 7), (2, 1, 5)]
