"""Date-time expressions do not depend on the session time zone."""

import pytest

from countlens.functions.datetime import format_iso, parse_local_time
from countlens.plans.testbed import raw_count_time_text
from countlens.sources.files import counts_from_raw


@pytest.fixture
def gap_zone(spark):
    # Sao Paulo moved its clocks from 00:00 to 01:00 on 1996-10-06, so that
    # midnight does not exist there as an instant.
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, "America/Sao_Paulo")
    yield
    spark.conf.set(key, before)


def test_ingest_keeps_a_wall_clock_time_that_the_session_zone_skips(spark, gap_zone):
    raw = spark.createDataFrame(
        [("1", "October 06, 1996 12:00:00 AM", "1", "A", "5"),
         ("2", "October 6, 1996 1:30:00 PM", "1", "A", "6")],
        "ID string, Date_Time string, Sensor_ID string, Sensor_Name string, Hourly_Counts string",
    )
    for on_bad in ("fail", "null"):
        got = sorted(r.date_time for r in counts_from_raw(raw, on_bad=on_bad).collect())
        assert got == ["1996-10-06T00:00:00", "1996-10-06T13:30:00"], on_bad


def test_format_round_trip_in_gap_zone(spark, gap_zone):
    df = spark.createDataFrame(
        [("1996-10-06 00:00:00",), ("2019-12-31 23:59:59",), ("2020-02-29 12:00:00.250",)],
        "t string",
    ).selectExpr("cast(t as timestamp_ntz) as ts")
    rows = df.select(
        format_iso("ts").alias("iso"),
        raw_count_time_text("ts").alias("raw"),
    ).collect()
    assert [(r.iso, r.raw) for r in rows] == [
        ("1996-10-06T00:00:00", "October 06, 1996 12:00:00 AM"),
        ("2019-12-31T23:59:59", "December 31, 2019 11:59:59 PM"),
        ("2020-02-29T12:00:00", "February 29, 2020 12:00:00 PM"),
    ]
    back = df.select(
        format_iso(parse_local_time(raw_count_time_text("ts"), "MMMM d, yyyy h:mm:ss a")).alias("x")
    ).collect()
    assert [r.x for r in back] == ["1996-10-06T00:00:00", "2019-12-31T23:59:59", "2020-02-29T12:00:00"]


def test_format_iso_null_and_date(spark):
    df = spark.createDataFrame([(None,)], "d date").selectExpr(
        "d", "cast('2021-03-04' as date) as d2"
    )
    r = df.select(format_iso("d").alias("a"), format_iso("d2").alias("b")).first()
    assert r.a is None and r.b == "2021-03-04T00:00:00"


def test_fixed_offset_zones(spark):
    from countlens.functions.datetime import session_zone_is_fixed

    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    try:
        for zone, fixed in (("UTC", True), ("Etc/UTC", True), ("GMT", True), ("+05:30", True),
                            ("America/Sao_Paulo", False), ("Europe/Berlin", False)):
            spark.conf.set(key, zone)
            assert session_zone_is_fixed() is fixed, zone
    finally:
        spark.conf.set(key, before)


def test_fast_and_field_formatting_agree(spark):
    """date_format (used in fixed-offset zones) and the field-based text
    (used elsewhere) give the same text for the same wall clock."""
    df = spark.createDataFrame(
        [("1996-10-06 00:00:00",), ("2019-01-31 13:05:09",), ("2021-07-04 00:30:00.999",)], "t string"
    ).selectExpr("cast(t as timestamp_ntz) as ts")
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    out = {}
    try:
        for zone in ("UTC", "America/Sao_Paulo"):
            spark.conf.set(key, zone)
            out[zone] = [tuple(r) for r in df.select(format_iso("ts"), raw_count_time_text("ts")).collect()]
    finally:
        spark.conf.set(key, before)
    assert out["UTC"] == out["America/Sao_Paulo"]
    assert out["UTC"][0] == ("1996-10-06T00:00:00", "October 06, 1996 12:00:00 AM")
