"""Sources and sinks (FIXTURES.md section 4), with round trips in temp folders."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from countlens import schemas
from countlens.session import scratch_path
from countlens.sources import (
    overwrite_path,
    overwrite_table,
    passthrough_view,
    preview,
    publish_table,
    read_counts_csv,
    read_reference_json,
    read_table,
    register_table,
)
from countlens.streaming import stream_counts_csv
from tests.helpers import plan_text

def local(path):
    """Python-side path of a local ``file:`` URI (tests write fixtures with open())."""
    return path[len("file:"):] if path.startswith("file:") else path


CSV = (
    "ID,Date_Time,Year,Sensor_ID,Sensor_Name,Hourly_Counts\n"
    '1,"November 01, 2019 05:00:00 PM",2019,34,Flinders St,300\n'
    "2,junk,2019,39,Alfred Place,604\n"
)


@pytest.fixture()
def csv_dir(spark):
    d = local(scratch_path(spark, "csv"))
    os.makedirs(d)
    with open(os.path.join(d, "counts.csv"), "w") as f:
        f.write(CSV)
    return d


def test_csv_null_on_bad(spark, csv_dir):
    rows = read_counts_csv(spark, csv_dir, on_bad="null").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        (1, "2019-11-01T17:00:00", 34, "Flinders St", 300),
        (2, None, 39, "Alfred Place", 604),
    ]


def test_csv_fail_on_bad(spark, csv_dir):
    with pytest.raises(Exception):
        read_counts_csv(spark, csv_dir, on_bad="fail").collect()


def test_csv_reads_only_needed_columns(spark, csv_dir):
    df = read_counts_csv(spark, csv_dir, on_bad="null")
    schema_line = [ln for ln in plan_text(df).splitlines() if "ReadSchema" in ln][0]
    assert "Year" not in schema_line and "Hourly_Counts" in schema_line


def test_json_array_keeps_struct(spark):
    d = local(scratch_path(spark, "json"))
    os.makedirs(d)
    recs = [
        {"location_id": 1, "sensor_description": "T", "latitude": -37.8,
         "location": {"lon": 144.9, "lat": -37.8}},
        {"location_id": 2, "sensor_description": None, "location": None},
    ]
    with open(os.path.join(d, "ref.json"), "w") as f:
        json.dump(recs, f)
    df = read_reference_json(spark, d)
    assert df.schema == schemas.SENSOR_REFERENCE
    rows = df.orderBy("location_id").collect()
    assert rows[0].location.lon == 144.9 and rows[0].location.lat == -37.8
    assert rows[1].location is None and rows[1].sensor_description is None


def test_register_is_idempotent_and_overwrite_replaces(spark):
    loc = scratch_path(spark, "tbl")
    df = spark.createDataFrame([(1, "a")], "location_id int, sensor_description string")
    register_table(spark, "t_reg", df.schema, loc)
    overwrite_table(df, "t_reg")
    register_table(spark, "t_reg", df.schema, scratch_path(spark, "other"))  # no-op
    assert spark.table("t_reg").count() == 1
    overwrite_table(spark.createDataFrame([(2, "b"), (3, "c")], df.schema), "t_reg")
    assert sorted(r.location_id for r in spark.table("t_reg").collect()) == [2, 3]


def test_publish_switches_versions(spark):
    root = scratch_path(spark, "pub")
    v1 = publish_table(spark.createDataFrame([(1,)], "x int"), "db_pub.t", root)
    assert spark.table("db_pub.t").count() == 1
    v2 = publish_table(spark.createDataFrame([(2,), (3,)], "x int"), "db_pub.t", root)
    assert v1 != v2
    assert sorted(r.x for r in spark.table("db_pub.t").collect()) == [2, 3]
    # the old version is still intact on storage
    assert spark.read.parquet(v1).count() == 1


def test_publish_with_new_columns_updates_the_table_schema(spark):
    root = scratch_path(spark, "pub-schema")
    publish_table(spark.createDataFrame([(1, 10)], "a int, b bigint"), "db_pub.s", root)
    publish_table(spark.createDataFrame([(2, 20, "x")], "a int, b int, c string"), "db_pub.s", root)
    t = spark.table("db_pub.s")
    assert t.dtypes == [("a", "int"), ("b", "int"), ("c", "string")]
    assert [tuple(r) for r in t.collect()] == [(2, 20, "x")]


def test_overwrite_path_and_read_table(spark):
    p = scratch_path(spark, "path")
    overwrite_path(spark.range(3), p)
    overwrite_path(spark.range(5), p)
    assert read_table(spark, p).count() == 5


def test_view_and_preview(spark):
    spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 7.0)], "k int, v double").createOrReplaceTempView("src_v")
    v = passthrough_view(spark, "pass_v", "src_v")
    assert v.count() == 3
    top = preview(v, 2, [F.col("v").desc()]).collect()
    assert [r.k for r in top] == [2, 3]


def test_streaming_ingest_is_incremental(spark):
    landing = local(scratch_path(spark, "landing"))
    out = scratch_path(spark, "out")
    ckpt = scratch_path(spark, "ckpt")
    os.makedirs(landing)
    header = ("ID", "Date_Time", "Year", "Sensor_ID", "Sensor_Name", "Hourly_Counts")
    with open(os.path.join(landing, "a.csv"), "w") as f:
        f.write(CSV)
    q = stream_counts_csv(spark, landing, out, ckpt, raw_columns=header)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 2
    with open(os.path.join(landing, "b.csv"), "w") as f:
        f.write("ID,Date_Time,Year,Sensor_ID,Sensor_Name,Hourly_Counts\n"
                '3,"May 1, 2020 1:00:00 AM",2020,1,X,5\n')
    q = stream_counts_csv(spark, landing, out, ckpt, raw_columns=header)
    q.awaitTermination()
    rows = spark.read.parquet(out).orderBy("id").collect()
    assert [r.id for r in rows] == [1, 2, 3]  # first file not re-read
    assert rows[2].date_time == "2020-05-01T01:00:00"
    assert rows[1].date_time is None


def test_bad_on_bad_value(spark, csv_dir):
    with pytest.raises(ValueError):
        read_counts_csv(spark, csv_dir, on_bad="drop")


def test_overwrite_table_matches_columns_by_name(spark):
    loc = scratch_path(spark, "byname")
    register_table(spark, "t_byname", schemas.SENSOR_COUNTS, loc)
    df = spark.createDataFrame(
        [(5, "A", 2, "2020-01-01T00:00:00", 7)],
        "hourly_count int, sensor_name string, sensor_id int, date_time string, id int",
    )
    overwrite_table(df, "t_byname")
    r = spark.table("t_byname").first()
    assert (r.id, r.date_time, r.sensor_id, r.sensor_name, r.hourly_count) == (
        7, "2020-01-01T00:00:00", 2, "A", 5,
    )
    with pytest.raises(ValueError):
        overwrite_table(df.drop("id"), "t_byname")


def test_overwrite_partitions_replaces_only_present_months(spark):
    from countlens.sources import overwrite_partitions

    loc = scratch_path(spark, "bymonth")
    schema = "k int, v int, year_month string"
    register_table(
        spark, "t_bymonth", spark.createDataFrame([], schema).schema, loc, partition_by=["year_month"]
    )
    overwrite_partitions(
        spark.createDataFrame([(1, 10, "2020-01"), (2, 20, "2020-02")], schema), "t_bymonth"
    )
    overwrite_partitions(
        spark.createDataFrame([(3, 30, "2020-02"), (4, 40, "2020-03")], schema), "t_bymonth"
    )
    got = sorted((r.k, r.v, r.year_month) for r in spark.table("t_bymonth").collect())
    assert got == [(1, 10, "2020-01"), (3, 30, "2020-02"), (4, 40, "2020-03")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "STATIC"


def test_overwrite_table_replaces_all_partitions_even_in_dynamic_session(spark):
    from countlens.sources.tables import overwrite_partitions, overwrite_table, register_table

    loc = scratch_path(spark, "ow-static")
    register_table(spark, "db_ow.p", StructType.fromDDL("v int, m string"), loc, partition_by=["m"])
    overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, m string"), "db_ow.p")
    overwrite_partitions(spark.createDataFrame([(3, "b")], "v int, m string"), "db_ow.p")
    assert sorted(tuple(r) for r in spark.table("db_ow.p").collect()) == [(1, "a"), (3, "b")]
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "dynamic")
    try:
        overwrite_table(spark.createDataFrame([(4, "c")], "v int, m string"), "db_ow.p")
    finally:
        spark.conf.unset(key)
    assert [tuple(r) for r in spark.table("db_ow.p").collect()] == [(4, "c")]


def test_overwrite_path_replaces_all_partitions_even_in_dynamic_session(spark):
    p = scratch_path(spark, "ow-path")
    overwrite_path(spark.createDataFrame([(1, "a"), (2, "b")], "v int, m string"), p, ["m"])
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "dynamic")
    try:
        overwrite_path(spark.createDataFrame([(3, "b")], "v int, m string"), p, ["m"])
    finally:
        spark.conf.unset(key)
    assert [tuple(r) for r in spark.read.parquet(p).collect()] == [(3, "b")]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_fail_on_bad_whatever_the_ansi_mode(spark, ansi):
    from countlens.sources.files import counts_from_raw

    schema = "ID string, Date_Time string, Sensor_ID string, Sensor_Name string, Hourly_Counts string"
    good = ("1", "November 01, 2019 05:00:00 PM", "3", "A", "7")
    key = "spark.sql.ansi.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, ansi)
    try:
        empty = ("2", None, None, "B", None)
        ok = counts_from_raw(spark.createDataFrame([good, empty], schema), on_bad="null")
        assert [r.hourly_count for r in ok.orderBy("id").collect()] == [7, None]
        for bad in (("x", *good[1:]), (good[0], "junk", *good[2:]), (*good[:4], "7.5"), empty):
            with pytest.raises(Exception):
                counts_from_raw(spark.createDataFrame([good, bad], schema)).collect()
    finally:
        spark.conf.set(key, before)


def test_streaming_ingest_by_month(spark):
    landing = local(scratch_path(spark, "landing-m"))
    out = scratch_path(spark, "out-m")
    ckpt = scratch_path(spark, "ckpt-m")
    os.makedirs(landing)
    header = ("ID", "Date_Time", "Year", "Sensor_ID", "Sensor_Name", "Hourly_Counts")
    with open(os.path.join(landing, "a.csv"), "w") as f:
        f.write(CSV)
    q = stream_counts_csv(spark, landing, out, ckpt, raw_columns=header, by_month=True)
    q.awaitTermination()
    df = spark.read.parquet(out)
    folders = sorted(os.listdir(local(out)))
    assert folders[:2] == ["_spark_metadata", "year_month=2019-11"] and len(folders) == 3
    assert folders[2].startswith("year_month=unparsed-")  # as the batch ingest has it
    (first, second) = df.orderBy("id").collect()
    assert (first.id, first.year_month, second.id) == (1, "2019-11", 2) and second.year_month.startswith("unparsed-")
    assert "PartitionFilters: [isnotnull(year_month" in plan_text(df.filter("year_month = '2019-11'"))


def test_fail_on_bad_from_a_thread_without_active_session(spark):
    """The DataFrame's own session decides the error handling, also where
    the building thread has no active session."""
    import threading

    from pyspark.sql import SparkSession

    from countlens.sources.files import counts_from_raw

    schema = "ID string, Date_Time string, Sensor_ID string, Sensor_Name string, Hourly_Counts string"
    raw = spark.createDataFrame([("1", "junk", "3", "A", "x")], schema)
    key = "spark.sql.ansi.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    out = {}

    def build_and_run():
        out["active"] = SparkSession.getActiveSession()
        try:
            counts_from_raw(raw, on_bad="fail").collect()
            out["error"] = None
        except Exception as e:  # noqa: BLE001 - any Spark error is the expected outcome
            out["error"] = e

    try:
        t = threading.Thread(target=build_and_run)
        t.start()
        t.join()
    finally:
        spark.conf.set(key, before)
    assert out["active"] is None
    assert out["error"] is not None


def _count_files(spark, name, **files):
    import os

    folder = scratch_path(spark, name).removeprefix("file:")
    os.makedirs(folder)
    for file, text in files.items():
        with open(os.path.join(folder, f"{file}.csv"), "w") as f:
            f.write(text)
    return folder


_HEADER = "ID,Date_Time,Sensor_ID,Sensor_Name,Hourly_Counts\n"
_TIME = '"November 01, 2019 05:00:00 PM"'


def test_headers_are_compared_or_matched_per_file(spark):
    folder = _count_files(
        spark, "mixed",
        a=_HEADER + f"1,{_TIME},7,A,50\n",
        b=f"Hourly_Counts,Extra,Sensor_ID,ID,Sensor_Name,Date_Time\n777,x,9,2,B,{_TIME}\n",
    )
    with pytest.raises(Exception):
        read_counts_csv(spark, folder).collect()
    got = sorted(tuple(r) for r in read_counts_csv(spark, folder, mixed_headers=True).collect())
    assert got == [(1, "2019-11-01T17:00:00", 7, "A", 50), (2, "2019-11-01T17:00:00", 9, "B", 777)]
    lost = _count_files(spark, "mixed2", a=_HEADER + f"1,{_TIME},7,A,50\n", b="1,2,3\n")
    with pytest.raises(ValueError, match="without a header"):
        read_counts_csv(spark, lost, mixed_headers=True)


@pytest.mark.parametrize("line", [f"1,{_TIME},7,A", f"1,{_TIME},7,A,5,6", f"1,{_TIME},7,A,", ",,,,", f"x,{_TIME},7,A,5"])
def test_ragged_lines_and_empty_fields_fail(spark, line):
    folder = _count_files(spark, "ragged", a=_HEADER + f"9,{_TIME},7,A,50\n{line}\n")
    for columns in (["*"], ["id"], ["sensor_name"]):
        if line.startswith("x") and columns == ["sensor_name"]:
            continue  # a bad number fails where it is read
        with pytest.raises(Exception):
            read_counts_csv(spark, folder).select(*columns).collect()
    kept = read_counts_csv(spark, folder, on_bad="null", bad_line_col="bad_line")
    assert kept.count() == 2
    bad = [r for r in kept.collect() if r.id != 9][0]
    assert (bad.bad_line is not None) == (line.count(",") - 1 != 4 and not line.startswith(",,"))
    assert None in (bad.id, bad.hourly_count, bad.sensor_id) or bad.bad_line == line


def test_ids_beyond_int_and_the_narrow_form(spark):
    folder = _count_files(spark, "wide", a=_HEADER + f"3000000000,{_TIME},7,A,50\n")
    assert read_counts_csv(spark, folder).first().id == 3_000_000_000
    narrow = read_counts_csv(spark, folder, on_bad="null", id_type="int")
    assert dict(narrow.dtypes)["id"] == "int" and narrow.first().id is None


def test_bad_json_values_fail_or_are_kept(spark):
    import os

    folder = scratch_path(spark, "badjson").removeprefix("file:")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.json"), "w") as f:
        f.write('{"location_id": 1, "sensor_description": "X"}\n{"location_id": "zz", "sensor_description": "Y"}\n')
    with pytest.raises(Exception):
        read_reference_json(spark, folder).collect()
    got = sorted((r.sensor_description, r.location_id) for r in read_reference_json(spark, folder, on_bad="null").collect())
    assert got == [("X", 1), ("Y", None)]


def test_existing_table_with_other_columns_is_refused(spark):
    from pyspark.sql.types import IntegerType, StructField, StructType

    from countlens.sources.tables import register_table

    one, two = (StructType([StructField(n, IntegerType())]) for n in ("a", "b"))
    where = scratch_path(spark, "it's here")
    register_table(spark, "t_refused", one, where)
    register_table(spark, "t_refused", one, where)
    with pytest.raises(ValueError, match="exists with columns"):
        register_table(spark, "t_refused", two, where)


def test_permanent_view_follows_its_table(spark):
    name = "t_viewed_" + os.path.basename(scratch_path(spark, "v")).replace("-", "_")
    publish_table(spark.range(3), name, scratch_path(spark, "viewed"))
    view = passthrough_view(spark, f"views_db.{name}_v", name, temporary=False)
    assert view.count() == 3 and not spark.catalog.getTable(f"views_db.{name}_v").isTemporary
    publish_table(spark.range(5), name, scratch_path(spark, "viewed"))
    assert spark.table(f"views_db.{name}_v").count() == 5
