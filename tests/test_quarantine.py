"""Quarantine of bad lines, and the failing rows of all checks from one scan."""

import os

import pytest
from pyspark.sql import functions as F

from countlens.operators import checks as ck
from countlens.plans import testbed as tb
from countlens.session import scratch_path
from countlens.sources.quarantine import TooManyBadLines, land_with_quarantine
from tests.helpers import plan_text
from tests.test_jobs import local

SF = "/root/testdata/sf0.001"
LINES = [
    '1,"March 01, 2019 10:00:00 AM",1,A,5',
    '2,"March 99, 2019 10:00:00 AM",1,A,5',
    'x,"March 01, 2019 10:00:00 AM",1,A,many',
    '4,"March 01, 2019 10:00:00 AM",1,A',
    '5,"March 01, 2019 10:00:00 AM",1,A,5,6',
    ',"March 01, 2019 10:00:00 AM",1,,5',
    '7,"March 01, 2019 10:00:00 AM",,A,5',
]


def _landing(spark):
    land = local(scratch_path(spark, "q-land"))
    os.makedirs(land)
    for name, lines in (("a.csv", LINES), ("b.csv", LINES[:1] * 3), ("c.csv", [])):
        with open(os.path.join(land, name), "w") as f:
            f.write("\n".join(["ID,Date_Time,Sensor_ID,Sensor_Name,Hourly_Counts", *lines]) + "\n")
    return land


def test_every_line_is_good_or_set_aside_with_its_reason(spark):
    landed = land_with_quarantine(spark, _landing(spark), scratch_path(spark, "q"))
    assert landed.good.count() == 4 and landed.bad.count() == 6
    counts = {(os.path.basename(r.file), r.reason): r.n_lines for r in landed.counts.collect()}
    assert counts == {
        ("a.csv", None): 1,
        ("b.csv", None): 3,
        ("a.csv", "malformed Date_Time"): 1,
        ("a.csv", "malformed ID; malformed Hourly_Counts"): 1,
        ("a.csv", "wrong number of fields"): 2,
        ("a.csv", "empty ID; empty Sensor_Name"): 1,
        ("a.csv", "empty Sensor_ID"): 1,
    }
    bad = {r.reason: r for r in landed.bad.collect()}
    assert bad["wrong number of fields"].line in LINES[3:5]
    assert bad["malformed Date_Time"].fields == ["2", "March 99, 2019 10:00:00 AM", "1", "A", "5"]
    good = landed.good.first()
    assert good.date_time == "2019-03-01T10:00:00" and good.year_month == "2019-03" and len(good.file_key) == 64


def test_gate_on_the_share_of_bad_lines(spark):
    land = _landing(spark)
    with pytest.raises(TooManyBadLines, match="6 of 10"):
        land_with_quarantine(spark, land, scratch_path(spark, "q"), max_bad_share=0.5)
    land_with_quarantine(spark, land, scratch_path(spark, "q"), max_bad_share=0.6)


def test_failing_rows_equal_the_violations_of_each_check_in_one_scan(spark):
    counts = tb._defective_counts(spark, SF)
    checks = [c for c in ck.sensor_counts_checks() if c.kind == "row"]
    got = ck.failing_rows(counts, checks)
    want = None
    for c in checks:
        part = ck.violations(counts, c).withColumns({"column_name": F.lit(c.column), "check_name": F.lit(c.name)})
        want = part if want is None else want.unionByName(part)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str) and not got.isEmpty()
    scans = [plan_text(df).count("Scan parquet") for df in (ck.failing_rows(counts, checks), counts)]
    assert scans[0] == scans[1]
    with pytest.raises(ValueError, match="unique"):
        ck.failing_rows(counts, [ck.unique("id")])
    assert ck.failing_rows(counts, []).count() == 0
