"""One JSON array read by many tasks, against the reader that takes a file in one."""

import json
import os

import pytest
from pyspark.sql import functions as F

from countlens import schemas
from countlens.session import scratch_path
from countlens.sources.files import read_reference_json
from countlens.sources.json_array import BrokenArray, read_json_array
from tests.test_jobs import local

TEXTS = ["plain", 'a "quoted" {word}', "}{][", "back\\slash", 'ends in \\"', "}}}", "é ü 漢字 }", "", None, "line\nbreak, [x]", '\\\\"}']


def _record(i):
    text = TEXTS[i % len(TEXTS)]
    return {"location_id": i, "sensor_description": text, "sensor_name": f"S{i}", "latitude": i / 2, "location": {"lon": float(i), "lat": 1.0}}


def _write(spark, *documents):
    land = local(scratch_path(spark, "json-array"))
    os.makedirs(land)
    for i, text in enumerate(documents):
        with open(os.path.join(land, f"{i}.json"), "w", encoding="utf-8") as f:
            f.write(text)
    return land


def _rows(df):
    return sorted((r.location_id, r.sensor_description, r.sensor_name, r.latitude, r.location and tuple(r.location)) for r in df.collect())


def test_equals_the_one_task_reader_however_ranges_cut_it(spark):
    records = [_record(i) for i in range(300)]
    land = _write(
        spark, json.dumps(records[:150], ensure_ascii=False), json.dumps(records[150:], indent=2), "[]", " [ ] \n", json.dumps([_record(999)]) + "\n"
    )
    want = _rows(read_reference_json(spark, land, multi_line=True))
    assert len(want) == 301
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("300", "1111", before):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            tasks = spark.read.option("lineSep", "}").text(land).select(F.spark_partition_id()).distinct().count()
            assert _rows(read_json_array(spark, land, schemas.SENSOR_REFERENCE)) == want
            assert size == before or tasks > 20
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bad_values_and_broken_files(spark):
    land = _write(spark, json.dumps([_record(1), {"location_id": "many"}]))
    assert sorted((r.location_id for r in read_json_array(spark, land, schemas.SENSOR_REFERENCE, "null").collect()), key=str) == [1, None]
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        read_json_array(spark, land, schemas.SENSOR_REFERENCE).collect()
    for broken in ('[{"location_id": 1}, {"location_id": 2', '[{"sensor_name": "x}]'):
        with pytest.raises(BrokenArray):
            read_json_array(spark, _write(spark, broken), schemas.SENSOR_REFERENCE)
