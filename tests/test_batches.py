"""The count mart kept by batches, against a mart built from the files' last contents alone."""

import json
import os

import pytest
from pyspark.sql import functions as F

from countlens import schemas
from countlens.plans import batches, jobs
from countlens.plans.batches import CountMart
from countlens.plans.reports import top_n_by_day, top_n_by_month
from countlens.session import scratch_path
from countlens.sources.tables import publish_table
from tests.helpers import plan_text
from tests.test_jobs import local

DIM = [(1, "Town Hall"), (2, "Bridge"), (3, "Station")]


def _file(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("ID,Date_Time,Sensor_ID,Sensor_Name,Hourly_Counts\n")
        for r in rows:
            f.write(",".join("" if v is None else f'"{v}"' for v in r) + "\n")
    return os.path.join(folder, name)


def _row(i, month="March", day=1, sensor=1, n=5, year=2019):
    return (i, f"{month} {day:02d}, {year} 10:00:00 AM", sensor, "A", n)


def _mart(spark, name, **kw):
    raw = f"{name}_raw"
    dim = spark.createDataFrame(DIM, "location_id int, sensor_description string")
    publish_table(dim, f"{raw}.{jobs.SENSOR_REFERENCE}", scratch_path(spark, name))
    return CountMart(spark, scratch_path(spark, name + "-mart"), raw, f"{name}_report", n=2, id_ranges=4, **kw)


def _state(mart):
    """All tables of a mart, without what tells one mart's files from another's."""
    t = mart.spark.table
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    return {
        "counts": rows(t(mart.counts).select(*schemas.SENSOR_COUNTS.names, F.substring("year_month", 1, 8))),
        "days": rows(t(mart.days).withColumn("year_month", F.substring("year_month", 1, 8))),
        "failures": rows(t(mart.failures).groupBy("column_name", "check_name").agg(F.sum("failures")).filter("sum(failures) > 0")),
        "ids": rows(t(mart.ids)),
        "duplicates": rows(t(mart.duplicates)),
        "top_by_day": rows(t(mart.top_by_day)),
        "top_by_month": rows(t(mart.top_by_month)),
        "bits": rows(t(mart.index).filter("block is not null").select("block", "bits", F.substring("year_month", 1, 8))),
    }


def _fresh(spark, name, *files):
    """A mart that took the files in one batch each, in order, and nothing else."""
    mart = _mart(spark, name)
    for k, f in enumerate(files):
        assert mart.apply(f"b{k}", f, on_bad="null")
    return _state(mart)


def test_a_corrected_file_leaves_exactly_its_rows(spark):
    """Bad times, times that move to another month, rows that go, rows without an id, a file left with no row."""
    land = local(scratch_path(spark, "b-land"))
    mart = _mart(spark, "b_one")
    one = [_row(1), (2, "no time", 1, "A", 3), _row(3, "April"), (None, "March 03, 2019 10:00:00 AM", 2, "B", 9), _row(4, "May")]
    other = [_row(10, "March", 5, 2, 7), _row(11, "April", 6, 2, 1)]
    _file(land, "one.csv", one), _file(land, "other.csv", other)
    mart.apply("first", land, on_bad="null")
    assert mart.spark.table(mart.counts).filter("year_month like 'unparsed-%'").count() == 1
    one = [_row(1), _row(2, "June"), _row(3, "July"), (None, "March 03, 2019 10:00:00 AM", 2, "B", 10)]
    mart.apply("second", _file(land, "one.csv", one), on_bad="null")
    stored = mart.spark.table(mart.counts)
    assert stored.filter("id = 2").select("year_month").collect() == [("2019-06",)]
    assert stored.filter("id = 3").select("year_month").collect() == [("2019-07",)]
    assert stored.filter("id = 4 or year_month in ('2019-05') or year_month like 'unparsed-%'").count() == 0
    assert [r.hourly_count for r in stored.filter("id is null").collect()] == [10]
    assert sorted(r.id for r in stored.filter("id is not null").collect()) == [1, 2, 3, 10, 11]
    assert {(r.day.isoformat(), r.sensor_id, r.total) for r in spark.table(mart.days).collect()} == {
        ("2019-03-01", 1, 5), ("2019-03-03", 2, 10), ("2019-03-05", 2, 7), ("2019-04-06", 2, 1), ("2019-06-01", 1, 5), ("2019-07-01", 1, 5)
    }
    assert spark.table(mart.failures).filter("failures > 0 and check_name = 'not_null' and column_name = 'date_time'").isEmpty()
    assert {r.id for r in spark.table(f"b_one_report.{jobs.FAILING_ROWS}").collect()} == {None}
    mart.apply("third", _file(land, "one.csv", []), on_bad="null")
    assert stored.sparkSession.table(mart.counts).count() == 2
    assert {r.date for r in mart.spark.table(mart.top_by_day).collect()} == {"2019-03-05", "2019-04-06"}


def test_rows_replace_an_id_wherever_it_is(spark):
    """Another file's row with the same id, in another month, goes; its neighbours stay."""
    land = local(scratch_path(spark, "b-ids"))
    mart = _mart(spark, "b_ids")
    mart.apply("a", _file(land, "a.csv", [_row(i, "March", i % 28 + 1) for i in range(-3, 200)]))
    mart.apply("b", _file(land, "b.csv", [_row(64, "April", 2, 3), _row(-2, "April", 3, 3)]))
    rows = {r.id: r.year_month for r in mart.spark.table(mart.counts).collect()}
    assert len(rows) == 203 and rows[64] == rows[-2] == "2019-04" and rows[63] == rows[65] == rows[-1] == "2019-03"
    assert mart.spark.table(mart.duplicates).count() == 0


def test_duplicates_are_taken_back(spark):
    """Two rows of one id in different months of a batch; one of them moves, and the other's entry goes."""
    land = local(scratch_path(spark, "b-dup"))
    mart = _mart(spark, "b_dup")
    tested = lambda: {
        (r.column_name, r.check_name): r.failures for r in mart.data_tests().filter("table_name = 'sensor_counts'").collect()
    }
    mart.spark.sql(f"DROP TABLE {mart.dim}")
    dim = [(1, "Town Hall", "Outdoor", "A", 1.0, 1.0)]
    dim = mart.spark.createDataFrame(dim, "location_id int, sensor_description string, location_type string, status string, latitude double, longitude double")
    for c in ("installation_date", "direction_1", "direction_2"):
        dim = dim.withColumn(c, F.lit(None).cast("string"))
    publish_table(dim, mart.dim, scratch_path(spark, "b-dup-dim"))
    mart.apply("1", _file(land, "a.csv", [_row(1), _row(2), _row(1, "April"), _row(3), _row(3), _row(3)]))
    assert {(r.id, r.n) for r in mart.spark.table(mart.duplicates).collect()} == {(1, 2), (3, 3)}
    assert tested()[("id", "unique")] == 2
    mart.apply("2", _file(land, "b.csv", [_row(3, "May"), _row(5, "May"), _row(5, "June")]))
    assert {(r.id, r.n) for r in mart.spark.table(mart.duplicates).collect()} == {(1, 2), (5, 2)}
    mart.apply("3", _file(land, "a.csv", [_row(1), _row(2), _row(9, "April")]))
    assert {(r.id, r.n) for r in mart.spark.table(mart.duplicates).collect()} == {(5, 2)}
    assert tested()[("id", "unique")] == 1 and mart.spark.table(mart.ids).agg(F.sum("n")).first()[0] == 6


def test_a_batch_cut_off_at_each_step_is_completed(spark):
    """The writer is lost after each step's work, before it is recorded; the next one does the step again."""
    land = local(scratch_path(spark, "b-kill"))
    first = _file(land, "a.csv", [_row(1), (2, "bad", 1, "A", 3), _row(3, "April", 2, 2), _row(3, "May", 2, 2)])
    mart = _mart(spark, "b_kill")
    mart.apply("1", first, on_bad="null")
    second = _file(land, "a.csv", [_row(1, "June"), _row(2), _row(3, "April", 2, 2, 8)])
    side_by_side = ("index", "ids", "failures", "day_totals")
    for lost in (("landed",), ("planned",), ("counts",), side_by_side, ("rankings",), ("done",)):
        mart.on_step = lambda s, at=lost: (_ for _ in ()).throw(RuntimeError("lost")) if s in at else None
        with pytest.raises(RuntimeError, match="lost"):
            mart.apply("2", second, on_bad="null")
        assert mart.complete() == (lost in (("landed",), ("planned",)))
    mart.on_step = None
    assert mart.resume() == ["2"] and mart.complete()
    assert not mart.apply("2", second, on_bad="null")
    assert _state(mart) == _fresh(spark, "b_kill_fresh", second)
    rows = spark.table(mart.ledger).filter("batch_id = '2'").orderBy("at").collect()
    assert sorted(r.step for r in rows) == sorted(batches.STEPS) and {r.number for r in rows} == {2}
    assert json.loads(rows[1].detail)["partitions"][:4] == ["2019-03", "2019-04", "2019-05", "2019-06"]


def test_rankings_by_month_equal_a_full_build_and_open_touched_months_only(spark):
    land = local(scratch_path(spark, "b-rank"))
    mart = _mart(spark, "b_rank")
    rows = [_row(i, ("March", "April", "May")[i % 3], i % 7 + 1, i % 5, i % 11) for i in range(200)]
    mart.apply("1", _file(land, "a.csv", [*rows, (900, "bad", 1, "A", 3), (901, "worse", 2, "B", 4)]), on_bad="null")
    mart.apply("2", _file(land, "b.csv", [_row(500, "April", 3, 4, 999), _row(501, "August", 3, 4, 1)]))
    counts, dim = spark.table(mart.counts), spark.table(mart.dim)
    daily = top_n_by_day(counts, dim, n=2)
    for name, want in ((mart.top_by_day, daily), (mart.top_by_month, top_n_by_month(daily, dim, n=2))):
        got = spark.table(name).drop("part")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    for plan in (plan_text(mart.daily_ranking(["2019-04"])), plan_text(mart.monthly_ranking(["2019-04"]))):
        assert "PartitionFilters: [isnotnull(" in plan and "= 2019-04)" in plan
    mart.rank_again()
    assert sorted(map(tuple, spark.table(mart.top_by_day).drop("part").collect()), key=str) == sorted(map(tuple, daily.collect()), key=str)


def test_merge_counts_drops_the_unparsed_rows_of_a_corrected_file(spark):
    """The plain month layout, too, keeps no unparsed row that its file no longer has."""
    land, at = local(scratch_path(spark, "b-plain")), scratch_path(spark, "b-plain-table")
    path = _file(land, "a.csv", [_row(1), (2, "no time", 1, "A", 3)])
    name = jobs.ingest_counts_by_month(spark, path, at, "b_plain_raw", on_bad="null")
    assert spark.table(name).count() == 2
    batch = jobs.land_counts(spark, _file(land, "a.csv", [_row(1), _row(2)]), "null")
    (gone,) = jobs.corrected_files(spark, batch, "b_plain_raw")
    assert gone.startswith("unparsed-")
    jobs.merge_counts(spark, batch, at, "b_plain_raw")
    assert sorted((r.id, r.year_month) for r in spark.table(name).collect()) == [(1, "2019-03"), (2, "2019-03")]


def test_a_stream_merges_and_changes_nothing_twice(spark):
    """Micro-batches go through the ledger: rows replace those of their ids, also an unparsed one, a restart adds
    nothing, and a micro-batch delivered again is passed over."""
    from countlens.streaming import stream_counts_into

    land, checkpoint = local(scratch_path(spark, "b-stream")), scratch_path(spark, "b-stream-ckpt")
    mart = _mart(spark, "b_stream")

    def run():
        stream_counts_into(mart, land, checkpoint).awaitTermination()
        return sorted((r.id, r.year_month) for r in spark.table(mart.counts).filter("id is not null").collect())

    _file(land, "a.csv", [_row(1), (2, "bad", 1, "A", 3)])
    first = run()
    assert [i for i, _ in first] == [1, 2] and run() == first
    _file(land, "b.csv", [_row(1, "May"), _row(2), _row(3)])
    assert run() == [(1, "2019-05"), (2, "2019-03"), (3, "2019-03")]
    assert not mart.apply_rows("stream-0", spark.table(mart.counts)) and mart.complete()


def test_a_batch_looks_up_only_what_it_may_replace(spark, tmp_path):
    """The stored rows of other files with the batch's ids are all that a plan keeps to find the rows that stay."""
    mart = _mart(spark, "replacedonly")
    _file(tmp_path / "a", "a.csv", [_row(1), _row(2, day=2), _row(3, "April"), _row(3, "April", day=2), _row(4, "May")])
    mart.apply("a", str(tmp_path / "a"))
    _file(tmp_path / "b", "b.csv", [_row(3), _row(9), _row(4, "June")])
    batch = jobs.read_landed_counts(spark, str(tmp_path / "b"), keep_key=True)
    plan = mart._plan(batch, [])
    assert sorted(map(tuple, spark.read.parquet(plan["replaced"]).select("id", "n").collect())) == [(3, 2), (4, 1)]
    assert plan["partitions"] == ["2019-03", "2019-04", "2019-05", "2019-06"] and plan["empty"] == ["2019-04", "2019-05"]
    # Months that are rewritten anyway are not looked up in the index.
    assert mart._holding(batch, [], 3, 9, ["2019-03", "2019-06"]) == {"2019-04", "2019-05"}
    assert mart._holding(batch, [], 3, 9, ["2019-03", "2019-05", "2019-06"]) == {"2019-04"}


def test_rows_without_a_file_are_replaced_by_id_when_a_step_is_done_again(spark, tmp_path):
    mart = _mart(spark, "unfiled")
    _file(tmp_path / "a", "a.csv", [_row(1), _row(2, day=2)])
    mart.apply("a", str(tmp_path / "a"))
    _file(tmp_path / "b", "b.csv", [_row(2, n=7), _row(5, "April")])
    rows = jobs.read_landed_counts(spark, str(tmp_path / "b"), keep_key=True).withColumn("file_key", F.lit(None).cast("string"))
    plan = mart._plan(rows, [])
    for _ in range(2):
        mart._write_counts(rows, plan)
    assert sorted(map(tuple, spark.table(mart.counts).select("id", "hourly_count").collect())) == [(1, 5), (2, 7), (5, 5)]


def test_failing_rows_are_written_once_and_without_a_shuffle(spark, tmp_path, monkeypatch):
    """Most rows may fail a check, so they are not stored on the way nor dealt out anew."""
    mart = _mart(spark, "manyfailing")
    rows = [_row(i, "March" if i % 2 else "April", sensor=5000 + i, n=-1) for i in range(40)] + [_row(50, "May")]
    _file(tmp_path / "a", "a.csv", rows)
    seen, write = [], jobs.overwrite_partitions
    monkeypatch.setattr(jobs, "overwrite_path", lambda *a: pytest.fail("stored on the way"))

    def spy(df, name, *a, **k):
        seen.append((name, plan_text(df), k))
        return write(df, name, *a, **k)

    monkeypatch.setattr(jobs, "overwrite_partitions", spy)
    mart.apply("a", str(tmp_path / "a"))
    assert [(n.endswith(jobs.FAILING_ROWS), "Exchange" in plan, k) for n, plan, k in seen] == [(True, False, {"regroup": False})]
    got = spark.table(f"manyfailing_report.{jobs.FAILING_ROWS}").groupBy("year_month", "column_name").count().collect()
    assert sorted(map(tuple, got)) == [(m, c, 20) for m in ("2019-03", "2019-04") for c in ("hourly_count", "sensor_id")]
    _file(tmp_path / "a", "a.csv", [_row(i, "March") for i in range(4)])
    mart.apply("b", str(tmp_path / "a"))
    assert spark.table(f"manyfailing_report.{jobs.FAILING_ROWS}").count() == 0


def test_times_are_parsed_once_and_folders_taken_without_a_pattern(spark, tmp_path):
    _file(tmp_path / "a", "a.csv", [_row(1), (2, "no time", 1, "A", 3)])
    landed = jobs.read_landed_counts(spark, str(tmp_path / "a"), "null", keep_key=True, by_folder=True)
    plan = plan_text(landed, "simple").lower()
    assert plan.count("gettimestamp(") == 1 and "regexp" not in plan
    key = batches.file_key(f"file:{tmp_path}/a")
    got = sorted(map(tuple, landed.select("id", "date_time", "file_key", "year_month").collect()))
    assert got == [(1, "2019-03-01T10:00:00", key, "2019-03"), (2, None, key, f"unparsed-{key}")]


def test_partitions_that_a_file_names_are_not_looked_up_by_id(spark, tmp_path, monkeypatch):
    """A folder that lands again holds its old partitions by name alone, and an empty mart holds none."""
    mart = _mart(spark, "heldbyfile")
    monkeypatch.setattr(batches, "id_bits", lambda *a: pytest.fail("ids looked up"))
    batch = jobs.read_landed_counts(spark, _file(tmp_path / "a", "a.csv", [_row(1), _row(2, "May")]), keep_key=True)
    assert mart._holding(batch, [], 1, 2, []) == set()
    monkeypatch.undo()
    mart.apply("a", str(tmp_path / "a"))
    key = batch.select("file_key").first()[0]
    monkeypatch.setattr(batches, "id_bits", lambda *a: pytest.fail("ids looked up"))
    assert mart._holding(batch, [key], 1, 2, ["2019-03"]) == {"2019-05"}


def test_ids_are_grouped_once_and_unchanged_ranges_left(spark, tmp_path, monkeypatch):
    """The ids of the ranges that may change are dealt out once, in tasks of so many rows; what does not change is not written."""
    mart = _mart(spark, "idranges")
    far = batches.IDS_PER_RANGE
    path = _file(tmp_path / "a", "a.csv", [*[_row(i) for i in range(1, 30)], _row(far + 1), _row(2 * far + 1), _row(2 * far + 1)])
    mart.apply("a", path)
    dealt, deal = [], batches.dealt_in_order
    monkeypatch.setattr(batches, "dealt_in_order", lambda df, keys: dealt.append(deal(df, keys, 10)) or dealt[-1])
    again = jobs.read_landed_counts(spark, path, keep_key=True)
    assert mart._plan(again, [])["ranges"] == []
    assert dealt[0].rdd.getNumPartitions() == 10  # 32 rows land, 32 go, and 31 ids are stored
    _file(tmp_path / "a", "a.csv", [*[_row(i) for i in range(1, 30)], _row(far + 1), _row(2 * far + 1)])
    plan = mart._plan(again, [])
    assert plan["ranges"] == ["2"]
    mart._write_ids(plan)
    assert mart.spark.table(mart.duplicates).count() == 0 and mart.spark.table(mart.ids).count() == 31


def test_days_of_several_texts_are_ranked_by_their_sum(spark):
    """A day's rows are summed only where a text or a month other than the day's own stands for it."""
    mart = _mart(spark, "oddtexts")
    columns = "id bigint, date_time string, sensor_id int, sensor_name string, hourly_count int, file_key string, year_month string"
    rows = [(i, f"2019-03-{i % 5 + 1:02d}T10:00:00", i % 4, "A", i, "f", "2019-03") for i in range(40)]
    mart.apply_rows("a", spark.createDataFrame(rows, columns))
    assert mart._texts(spark.table(mart.days)) == (False, False)
    rows = [(100, "2019-3-1T10:00:00", 1, "A", 1000, "g", "2019-3-"), (101, "never", 1, "A", 7, "g", "never")]
    mart.apply_rows("b", spark.createDataFrame(rows, columns))
    assert mart._texts(spark.table(mart.days)) == (True, True)
    mart.rank_again()
    daily = top_n_by_day(spark.table(mart.counts), spark.table(mart.dim), n=2)
    got = spark.table(mart.top_by_day).drop("part")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, daily.collect()), key=str)


def test_sparse_ids_are_dealt_out_before_they_are_grouped(spark, monkeypatch):
    """Where each id has a block of its own, a sum per task would hold all of a scan task's ids."""
    from countlens.operators import periods

    monkeypatch.setattr(periods, "ROWS_PER_TASK", 100)
    sparse = spark.range(1000).select((F.col("id") * 64 + F.col("id") % 7).alias("id"), (F.col("id") % 3).alias("m"))
    bits = batches.id_bits(sparse, "m")
    text = plan_text(bits, "simple")
    assert "REPARTITION_BY_NUM" in text and text.index("partial_bit_or") < text.index("REPARTITION_BY_NUM")
    assert {tuple(r) for r in bits.collect()} == {(i % 3, i, 1 << (i % 7)) for i in range(1000)}
    dense = spark.range(1000).select("id", F.lit(0).alias("m"))
    assert "REPARTITION_BY_NUM" not in plan_text(batches.id_bits(dense, "m"))
