"""Places by range sort, against a sort in Python."""

import random

import pytest
from pyspark.sql import functions as F

from countlens.operators.ordering import placed
from countlens.operators.ranking import rank_by_range, rank_within


def _rows(n=3000):
    rng = random.Random(3)
    return [(rng.choice(["hot"] * 8 + ["a", "b", None]), i, rng.choice([None, 1, 2, 3, rng.randint(0, 50)])) for i in range(n)]


def _places(rows):
    out = {}
    for p in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == p), key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))
        out.update({r[1]: (k, len(own)) for k, r in enumerate(own)})
    return out


def test_places_and_sizes_equal_a_sort(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "p string, id long, v int").repartition(7)
    got = placed(df, ["p"], [F.col("v").desc_nulls_last(), F.col("id")])
    assert {r.id: (r.place, r.group_rows) for r in got.collect()} == _places(rows)
    assert got.columns == ["p", "id", "v", "place", "group_rows"]


def test_ranks_equal_the_window_for_any_n(spark):
    df = spark.createDataFrame(_rows(), "p string, id long, v int")
    for n in (1, 5, 900):
        want = sorted(map(tuple, rank_within(df, "p", "id", "v", n).collect()), key=str)
        assert sorted(map(tuple, rank_by_range(df, "p", "id", "v", n).collect()), key=str) == want
    assert rank_by_range(df, "p", "id", "v").count() == 3000
    with pytest.raises(ValueError):
        rank_by_range(df, "p", "id", "v", 0)


def test_no_partition_holds_a_hot_group(spark):
    """One group with all rows, many of them tied: its rows are spread over the sort's partitions."""
    df = spark.range(40_000).select(F.lit("p").alias("p"), "id", F.lit(1).alias("v"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rank_by_range(df, "p", "id", "v", 30_000)
        assert got.agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first() == (1, 30_000, 30_000)
        shares = got.sparkSession.read.parquet(*{f.rsplit("/", 1)[0] for f in got.inputFiles()})
        sizes = [r["count"] for r in shares.groupBy(F.shiftright("__at", 33)).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * 40_000 / 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_tables_and_clashing_names(spark):
    none = spark.createDataFrame([], "p string, id long, v int")
    assert placed(none, ["p"], [F.col("id")]).count() == 0 and rank_by_range(none, "p", "id", "v", 5).count() == 0
    with pytest.raises(ValueError, match="__share"):
        placed(none.withColumn("__share", F.lit(1)), ["p"], [F.col("id")])
