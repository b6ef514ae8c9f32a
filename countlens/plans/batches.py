"""A count mart that takes landed batches, each exactly once, and keeps its tables by partition.

``CountMart.apply`` lands a batch of count files and brings every table of the
mart up to date from the partitions that the batch touches:

* **counts** (by month): a row of the batch replaces the stored rows that have its
  id, and a file of the batch all rows that it landed before, in whatever
  partition they are. So a corrected time moves a row to its month, and a corrected
  file leaves exactly its own rows.
* **index** (by month): which ids (64 to a row, as bits) and files a partition holds.
  It names the partitions to rewrite without opening the counts.
* **id counts** (by ranges of ids): how many rows an id has, changed by the signed
  differences of each batch, and the **duplicates** among them. A duplicate that
  goes away in one month is taken back wherever its other row is.
* **day totals**, **check failures** and the **failing rows** themselves (by month),
  recomputed for touched partitions.
* **rankings** (by month): the daily ranking of touched months, and the monthly one
  of the same months from it. Days without a date are one period, kept apart.

Exactly once: each step of a batch is recorded in a ledger when its tables are
written. What a batch will change is found and stored before the first change,
and each step's result follows from what is stored before it, so a step
that was cut off is done again with the same result. ``resume`` completes
batches that stopped on the way; a batch that is done is not applied again.
One writer at a time; ``complete`` tells readers that no batch is half applied.

The driver sees partition names, file names and ledger rows, never data.
"""

from __future__ import annotations

import hashlib
import json
import re
import threading
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countlens import schemas
from countlens.operators.checks import run_checks, sensor_counts_checks
from countlens.operators.periods import dealt_by_group, dealt_day_totals, dealt_in_order
from countlens.operators.ranking import within_reach
from countlens.plans import jobs
from countlens.plans.reports import top_n_by_month, top_n_from_day_totals
from countlens.schemas import FILE_KEY, MONTH_COL, PART_COL, UNDATED
from countlens.sources.files import UNPARSED_PREFIX
from countlens.sources.tables import listed_partitions, overwrite_partitions, overwrite_path, register_table

INDEX = "sensor_counts_index"
ID_COUNTS = "sensor_counts_id_counts"
LEDGER = "sensor_counts_batches"

STEPS = ("landed", "planned", "counts", "index", "ids", "day_totals", "failures", "rankings", "done")

#: Ranges of ids are blocks of this many ids, dealt to a bounded number of partitions.
IDS_PER_RANGE = 1 << 20


def id_bits(rows: DataFrame, *by: str) -> DataFrame:
    """The ids of ``rows`` as bits: (``by``, ``block`` = id / 64, ``bits``), in tasks of bounded memory where
    nearly each id has a block of its own (``dealt_by_group`` measures that at once)."""
    bit = F.expr("shiftleft(1L, cast(id & 63 as int))")
    block = F.shiftright("id", 6).alias("block")
    bits = rows.filter("id is not null").select(*by, block, bit.alias("bit"))
    return dealt_by_group(bits, [*by, "block"]).groupBy(*by, "block").agg(F.bit_or("bit").alias("bits"))


class CountMart:
    """See the module's text. ``root``: a shared folder that the mart's files stay in.

    The sensor reference table (``raw_db.sensor_reference_data``) is read for the
    labels of the rankings; after it changes, ``rank_again`` ranks all months anew.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        raw_db: str = "raw",
        report_db: str = "report",
        n: int = 10,
        id_ranges: int = 1024,
        on_step: Callable[[str], None] | None = None,
    ):
        self.spark, self.root, self.n, self.id_ranges = spark, root.rstrip("/"), n, id_ranges
        self.on_step = on_step
        self._ledger_lock = threading.Lock()
        self.counts = f"{raw_db}.{jobs.SENSOR_COUNTS}"
        self.dim = f"{raw_db}.{jobs.SENSOR_REFERENCE}"
        self.index = f"{raw_db}.{INDEX}"
        self.ids = f"{raw_db}.{ID_COUNTS}"
        self.ledger = f"{raw_db}.{LEDGER}"
        self.duplicates = f"{report_db}.{jobs.DUPLICATE_IDS}"
        self.days = f"{report_db}.{jobs.DAY_TOTALS}"
        self.failures = f"{report_db}.{jobs.CHECK_FAILURES}"
        self.top_by_day = f"{report_db}.{jobs.TOP_BY_DAY}"
        self.top_by_month = f"{report_db}.{jobs.TOP_BY_MONTH}"
        for name, schema, part in (
            (self.counts, schemas.LANDED_COUNTS, MONTH_COL),
            (self.index, schemas.PARTITION_INDEX, MONTH_COL),
            (self.ids, schemas.ID_COUNTS, "id_range"),
            (self.duplicates, schemas.ID_COUNTS, "id_range"),
            (self.days, schemas.SENSOR_DAY_TOTALS, MONTH_COL),
            (self.failures, schemas.CHECK_FAILURES_BY_MONTH, MONTH_COL),
            (self.top_by_day, schemas.TOP_BY_DAY_BY_MONTH, PART_COL),
            (self.top_by_month, schemas.TOP_BY_MONTH_BY_MONTH, PART_COL),
            (self.ledger, schemas.BATCH_LEDGER, None),
        ):
            register_table(spark, name, schema, f"{self.root}/{name.replace('.', '/')}", [part] if part else None)

    # ------------------------------------------------------------- batches

    def apply(
        self, batch_id: str, csv_path: str, on_bad: str = "fail", mixed_headers: bool = False, by_folder: bool = False
    ) -> bool:
        """Land the count files under ``csv_path`` as batch ``batch_id`` and bring all tables up to
        date. Returns whether there was anything to do: a batch that is done is not applied again.
        ``by_folder``: what is landed again is a folder, whatever its files are called."""

        def land() -> tuple[DataFrame, list[str]]:
            rows = jobs.read_landed_counts(self.spark, csv_path, on_bad, mixed_headers, True, by_folder)
            # By the listing, so that a file without a row left replaces its rows too.
            listed = self.spark.read.text(csv_path).inputFiles()
            return rows, sorted({file_key(f.rsplit("/", 1)[0] if by_folder else f) for f in listed})

        return self._apply(batch_id, land)

    def apply_rows(self, batch_id: str, rows: DataFrame) -> bool:
        """``apply`` for rows as ``plans.jobs.read_landed_counts(keep_key=True)`` gives them."""

        def land() -> tuple[DataFrame, list[str]]:
            return rows, []

        return self._apply(batch_id, land)

    def resume(self) -> list[str]:
        """Complete the batches that stopped after they had landed; returns their ids."""
        opened = {b: steps for b, steps in self._batches().items() if "done" not in steps}
        for batch_id, steps in opened.items():
            self._complete(batch_id, steps)
        return list(opened)

    def complete(self) -> bool:
        """Whether all tables agree: no batch has begun and is not done."""
        return all("done" in steps for steps in self._batches().values() if "planned" in steps)

    def _batches(self) -> dict[str, dict[str, dict]]:
        """The steps of each batch, in the order of the batches."""
        rows = self.spark.table(self.ledger).orderBy("number", "at").collect()
        out: dict[str, dict[str, dict]] = {}
        for r in rows:
            out.setdefault(r["batch_id"], {})[r["step"]] = json.loads(r["detail"])
        return out

    def _record(self, batch_id: str, number: int, step: str, detail: dict) -> None:
        if self.on_step:
            self.on_step(step)
        with self._ledger_lock:  # appends to one folder don't mix
            self._append(batch_id, number, step, detail)

    def _append(self, batch_id: str, number: int, step: str, detail: dict) -> None:
        row = self.spark.range(1).select(
            F.lit(batch_id).alias("batch_id"),
            F.lit(number).cast("long").alias("number"),
            F.lit(step).alias("step"),
            F.lit(json.dumps(detail)).alias("detail"),
            F.current_timestamp().alias("at"),
        )
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/{self.ledger.replace('.', '/')}")
        self.spark.sql(f"REFRESH TABLE {self.ledger}")

    def _apply(self, batch_id: str, land) -> bool:
        self.resume()
        batches = self._batches()
        if "done" in batches.get(batch_id, {}):
            return False
        rows, files = land()
        path = f"{self.root}/landed/{uuid.uuid4().hex}"
        overwrite_path(rows.select(*schemas.LANDED_COUNTS.names), path)
        number = 1 + max((steps["landed"]["number"] for steps in batches.values()), default=0)
        landed = {"path": path, "files": files, "number": number}
        self._record(batch_id, number, "landed", landed)
        self._complete(batch_id, {"landed": landed})
        return True

    def _complete(self, batch_id: str, steps: dict[str, dict]) -> None:
        landed = steps["landed"]
        number = landed["number"]
        batch = self.spark.read.schema(schemas.LANDED_COUNTS).parquet(landed["path"])
        if "planned" not in steps:
            steps["planned"] = self._plan(batch, landed["files"])
            self._record(batch_id, number, "planned", steps["planned"])
        plan = steps["planned"]
        work = {
            "counts": lambda: self._write_counts(batch, plan),
            "index": lambda: self._write_index(plan),
            "ids": lambda: self._write_ids(plan),
            "day_totals": lambda: self._write_day_totals(plan),
            "failures": lambda: self._write_failures(plan),
            "rankings": lambda: self._write_rankings(plan["partitions"]),
            "done": lambda: None,
        }

        def run(chain: Sequence[str]) -> None:
            for step in chain:
                if step not in steps:
                    work[step]()
                    self._record(batch_id, number, step, {})

        run(["counts"])
        # The other tables follow from the counts and the plan, each chain by itself; their jobs share the cluster.
        chains = (["index"], ["ids"], ["failures"], ["day_totals", "rankings"])
        with ThreadPoolExecutor(len(chains)) as pool:
            for chain in [pool.submit(run, chain) for chain in chains]:
                chain.result()
        run(["done"])

    # --------------------------------------------------------------- a plan

    def _holding(
        self, batch: DataFrame, files: Sequence[str], low: int | None, high: int | None, months: Sequence[str]
    ) -> set[str]:
        """Partitions other than ``months``, which are rewritten anyway, that hold an id of the batch or rows of its files."""
        index = self.spark.table(self.index).filter(~F.col(MONTH_COL).isin(list(months)))
        # Each partition with rows has a row without a block; those that a file names need no look at their ids.
        named = index.filter("block is null").groupBy(MONTH_COL).agg(F.max(self._own(files))).collect()
        held, rest = {r[0] for r in named if r[1]}, sorted(r[0] for r in named if not r[1])
        if low is not None and rest:
            # The index is sorted by block, so its files' statistics leave out most of it.
            bits = id_bits(batch).select("block", F.col("bits").alias("wanted"))
            near = index.filter(F.col(MONTH_COL).isin(rest) & F.col("block").between(low >> 6, high >> 6)).join(bits, "block")
            near = near.filter(F.col("bits").bitwiseAND(F.col("wanted")) != 0)
            held |= {r[0] for r in near.select(MONTH_COL).distinct().collect()}
        return held

    def _own(self, files: Sequence[str]) -> Column:
        return F.coalesce(F.col(FILE_KEY).isin(list(files)), F.lit(False))

    def _kept(self, replaced: DataFrame, files: Sequence[str], partitions: Sequence[str]) -> DataFrame:
        """Rows of ``partitions`` that the batch does not replace. ``replaced``: see ``_plan``."""
        stored = self.spark.table(self.counts).filter(F.col(MONTH_COL).isin(list(partitions)))
        return stored.filter(~self._own(files)).join(replaced.select("id"), "id", "left_anti")

    def _plan(self, batch: DataFrame, files: Sequence[str]) -> dict:
        """What a batch will change, found before it changes anything."""
        # As many values as the batch has files and the mart has partitions.
        found = F.collect_set(FILE_KEY), F.collect_set(MONTH_COL), F.collect_set(self._range()), F.min("id"), F.max("id")
        keys, months, ranges, low, high = batch.agg(*found).first()
        files, months = sorted({*keys, *files}), set(months)
        held = self._holding(batch, files, low, high, sorted(months))
        partitions = sorted(months | held)
        left = sorted(held)  # partitions that rows only leave

        # The stored rows of other files whose id the batch has, by id: few, so that the counts need not be dealt out
        # anew to find what stays. A batch's rows without a file are known by id alone when a step is done again.
        changes = f"{self.root}/planned/{uuid.uuid4().hex}"
        stored = self.spark.table(self.counts).filter(F.col(MONTH_COL).isin(partitions))
        other = stored.filter(~self._own(files)).select("id").join(batch.select("id"), "id", "left_semi")
        unfiled = batch.filter(F.col(FILE_KEY).isNull() & F.col("id").isNotNull()).select("id")
        one = lambda n: F.lit(n).cast("long").alias("n")
        replaced = other.select("id", one(1)).unionByName(unfiled.select("id", one(0))).groupBy("id").agg(F.sum("n").alias("n"))
        overwrite_path(replaced, changes + "/replaced")
        replaced = self._replaced(changes + "/replaced")
        filled = {r[0] for r in self._kept(replaced, files, left).select(MONTH_COL).distinct().collect()} if left else set()

        # The ids of the ranges that may change, with their rows now and by how many the batch changes them, are
        # grouped once, dealt out by (range, id), so that the tables are written from the result file by file.
        own = stored.filter(self._own(files)).select("id")
        if not listed_partitions(self.spark, self.ids) <= set(ranges):
            ranges = sorted({*ranges, *own.agg(F.collect_set(self._range())).first()[0]})
        moved = batch.select("id", one(1)).unionByName(own.select("id", one(-1)))
        moved = moved.unionByName(replaced.select("id", (-F.col("n")).alias("n"))).filter("id is not null")
        moved = moved.select("id", "n", F.col("n").alias("change"), self._range().alias("id_range"))
        old = self.spark.table(self.ids).filter(F.col("id_range").isin(ranges)).withColumn("change", F.lit(0).cast("long"))
        both = dealt_in_order(old.unionByName(moved), ["id_range", "id"])
        now = both.groupBy("id_range", "id").agg(F.sum("n").alias("n"), F.sum("change").alias("change"))
        overwrite_path(now, changes + "/ids")
        now = self.spark.read.schema(now.schema).parquet(changes + "/ids")
        ranges = sorted(r[0] for r in now.filter("change <> 0").select("id_range").distinct().collect())
        return {
            "files": files,
            "partitions": partitions,
            "empty": sorted(held - filled),
            "ranges": ranges,
            "ids": changes + "/ids",
            "replaced": changes + "/replaced",
        }

    def _replaced(self, path: str) -> DataFrame:
        return self.spark.read.schema("id bigint, n bigint").parquet(path)

    def _range(self) -> Column:
        return F.pmod(F.floor(F.col("id") / IDS_PER_RANGE), F.lit(self.id_ranges)).cast("string")

    # ------------------------------------------------------------ the steps

    def _touched(self, plan: dict) -> DataFrame:
        return self.spark.table(self.counts).filter(F.col(MONTH_COL).isin(plan["partitions"]))

    def _write(self, df: DataFrame, name: str, plan: dict, sort_by: tuple[str, ...] = ()) -> None:
        overwrite_partitions(df, name, sort_by, plan["partitions"], plan["empty"])

    def _write_counts(self, batch: DataFrame, plan: dict) -> None:
        # A batch planned before its replaced rows were stored has all its ids looked up.
        ids = self._replaced(plan["replaced"]) if "replaced" in plan else batch.filter("id is not null")
        kept = self._kept(ids, plan["files"], plan["partitions"])
        self._write(batch.unionByName(kept.select(*batch.columns)), self.counts, plan, ("date_time",))

    def _write_index(self, plan: dict) -> None:
        rows = self._touched(plan)
        files = rows.select(FILE_KEY, MONTH_COL).distinct()  # so each partition with rows has one here
        self._write(id_bits(rows, MONTH_COL).unionByName(files, allowMissingColumns=True), self.index, plan, ("block",))

    def _write_ids(self, plan: dict) -> None:
        # A range that the batch leaves as it is was looked at too, as was an id that no row has any more.
        now = self.spark.read.schema(schemas.ID_COUNTS).parquet(plan["ids"]).filter("n > 0")
        now = now.filter(F.col("id_range").isin(plan["ranges"]))
        filled = now.groupBy("id_range").agg(F.max(F.col("n") > 1)).collect()
        twice = {r[0] for r in filled if r[1]}
        for name, rows, found in ((self.ids, now, {r[0] for r in filled}), (self.duplicates, now.filter("n > 1"), twice)):
            gone = sorted((set(plan["ranges"]) - found) & listed_partitions(self.spark, name))
            overwrite_partitions(rows, name, ("id",), sorted(found), gone, regroup=False)

    def _write_day_totals(self, plan: dict) -> None:
        totals = dealt_day_totals(self._touched(plan), "date_time", "sensor_id", "hourly_count", keys=(MONTH_COL,))
        self._write(totals, self.days, plan)

    def _write_failures(self, plan: dict) -> None:
        checks = [c for c in sensor_counts_checks() if c.kind == "row"]
        touched = self._touched(plan)
        self._write(run_checks(touched, checks, jobs.SENSOR_COUNTS, by=(MONTH_COL,)), self.failures, plan)
        report_db = self.failures.rsplit(".", 1)[0]
        at = f"{self.root}/{report_db.replace('.', '/')}/{jobs.FAILING_ROWS}"
        counted = self.spark.table(self.failures).filter(F.col(MONTH_COL).isin(plan["partitions"]) & (F.col("failures") > 0))
        failing = {r[0] for r in counted.select(MONTH_COL).distinct().collect()}
        jobs.refresh_failing_rows(
            self.spark, touched, at, report_db, partitions=plan["partitions"], empty=plan["empty"], failing=failing
        )

    # ------------------------------------------------------------ rankings

    def daily_ranking(self, partitions: Sequence[str] | None = None) -> DataFrame:
        """The daily ranking of the dated days of ``partitions`` (None: all), from their day totals alone."""
        days = self.spark.table(self.days).filter("day is not null")
        return self._ranked(days if partitions is None else days.filter(F.col(MONTH_COL).isin(list(partitions))))

    def _ranked(self, days: DataFrame, summed: bool = False) -> DataFrame:
        """``summed``: the days are known to have one row per sensor (``_texts``)."""
        dim = self.spark.table(self.dim)
        if summed and self.n <= 100:
            days = within_reach(days, "day", "sensor_id", "total", self.n)
        else:
            days = jobs._one_row_per_day(days)
        ranked = top_n_from_day_totals(days, dim, n=self.n)
        return ranked.withColumn(PART_COL, F.coalesce(F.substring("date", 1, 7), F.lit(UNDATED)))

    def _texts(self, days: DataFrame) -> tuple[bool, bool]:
        """Whether ``days`` have rows without a day, and rows whose day stands in another text or month than its own.
        Without the latter a dated day has one row per sensor, as a day's totals have one per text, month and sensor."""
        day = F.col("day").cast("string")
        plain = F.col("day_text").eqNullSafe(day) & F.col(MONTH_COL).eqNullSafe(day.substr(1, 7))
        undated = F.col("day").isNull()
        return tuple(n > 0 for n in days.agg(F.count_if(undated), F.count_if(~undated & ~plain)).first())

    def monthly_ranking(self, parts: Sequence[str] | None = None) -> DataFrame:
        """The monthly ranking of ``parts`` (None: all), from their stored daily ranking alone."""
        daily = self.spark.table(self.top_by_day)
        daily = daily if parts is None else daily.filter(F.col(PART_COL).isin(list(parts)))
        monthly = top_n_by_month(daily, self.spark.table(self.dim), n=self.n)
        return monthly.withColumn(PART_COL, F.coalesce("year_month", F.lit(UNDATED)))

    def _write_rankings(self, partitions: Sequence[str] | None) -> None:
        days = self.spark.table(self.days)
        touched = days if partitions is None else days.filter(F.col(MONTH_COL).isin(list(partitions)))
        if partitions is None:
            partitions = [r[0] for r in days.select(MONTH_COL).distinct().collect()]
        undated, odd = self._texts(touched)
        daily = self._ranked(touched.filter("day is not null"), summed=not odd)
        parts = [p for p in partitions if not p.startswith(UNPARSED_PREFIX)]
        # Days without a date are one period over all partitions: read again only if that may have changed.
        ranked_before = self.spark.table(self.top_by_day).filter(F.col(PART_COL) == UNDATED)
        if undated or not ranked_before.isEmpty():
            parts.append(UNDATED)
            daily = daily.unionByName(self._ranked(days.filter("day is null")))
        for df, name, sort_by in (
            (daily, self.top_by_day, ("date", "rank")),
            (None, self.top_by_month, ("year_month", "rank")),
        ):
            df = self.monthly_ranking(parts) if df is None else df
            path = f"{self.root}/planned/{uuid.uuid4().hex}"
            overwrite_path(df, path)
            df = self.spark.read.parquet(path)
            found = {r[0] for r in df.select(PART_COL).distinct().collect()}
            overwrite_partitions(df, name, sort_by, parts, sorted(set(parts) - found))

    def rank_again(self) -> None:
        """Rank all months anew, for a changed sensor reference."""
        self._write_rankings(None)

    # --------------------------------------------------------------- checks

    def data_tests(self) -> DataFrame:
        """The data tests of counts, reference and daily ranking, from the kept tables: no stored count is read."""
        raw_db, report_db = self.counts.rsplit(".", 1)[0], self.days.rsplit(".", 1)[0]
        return jobs.data_tests(
            self.spark, raw_db, report_db, self.n, check_failures_table=self.failures, duplicate_ids_table=self.duplicates
        )


def file_key(path: str) -> str:
    """The key of a listed file, as ``sources.files.with_month`` gives it to the file's rows
    (whose paths have local files as ``file:/``, where listings write ``file:///``)."""
    return hashlib.sha256(re.sub("^file:/+", "file:/", path).encode()).hexdigest()
