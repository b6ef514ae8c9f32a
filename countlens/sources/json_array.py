"""Reading one large JSON array with many tasks.

Spark reads a JSON array document in one task. Here the text is read in byte
ranges, as chunks that end with ``}``, and record bounds are found by counting:
whether a chunk begins inside a string follows from the quotes before it, and its
depth from the braces outside of strings before it. Both are sums, taken per byte
range first and over the ranges after that, so a file of any size is read by as
many tasks as it has ranges, and a record is put together from its chunks alone,
however the ranges cut it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from countlens.operators.ordering import written


class BrokenArray(ValueError):
    """A file whose strings or braces don't end."""


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """(``file``, ``start`` of the byte range, ``at`` in it, ``chunk``, and per starting state the chunk's sums)."""
    text = spark.read.option("lineSep", "}").text(path)
    text = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("chunk"),
    )
    # An escaped quote ends nothing. A chunk can't end in half an escape: "\}" is none.
    pieces = F.split(F.regexp_replace("chunk", r"\\.", ""), '"')
    braces = F.transform(pieces, lambda p, i: F.struct((i % 2).alias("odd"), F.regexp_count(p, F.lit(r"\{")).alias("n")))
    total = lambda odd: F.aggregate(
        F.filter(braces, lambda x: x["odd"] == odd), F.lit(0).cast("long"), lambda a, x: a + x["n"]
    )
    return text.withColumn("quotes", (F.size(pieces) - 1).cast("long")).withColumn("even", total(0)).withColumn("odd", total(1))


def _running(df: DataFrame, value: str, out: str) -> DataFrame:
    """``df`` with the sum of ``value`` over all earlier chunks of the file, by way of the ranges' sums."""
    within = Window.partitionBy("file", "start").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = df.groupBy("file", "start").agg(F.sum(value).alias("__n"))
    ranges = ranges.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    own = F.coalesce(F.sum(value).over(within), F.lit(0))
    return df.withColumn("__own", own).join(ranges, ["file", "start"]).withColumn(out, F.col("__before") + F.col("__own")).drop("__before", "__own")


def read_json_array(spark: SparkSession, path: str, schema: StructType, on_bad: str = "fail") -> DataFrame:
    """The records of files that hold one JSON array of objects each, like ``spark.read.json`` with
    ``multiLine``, from many tasks a file. White space and nesting are free; an empty array has no record.
    ``on_bad="fail"`` raises on a record that is no JSON or has a value of another type; ``"null"`` keeps
    it with NULLs there. Raises ``BrokenArray`` if a file's strings or braces don't end."""
    chunks = written(_chunks(spark, path), "json-chunks")  # the ranges' order is fixed from here on
    placed = _running(chunks, "quotes", "quotes_before")
    inside = F.col("quotes_before") % 2 == 1
    closes = (F.col("quotes_before") + F.col("quotes")) % 2 == 0
    # An array ends in "]" after its last "}": a file's last chunk, the only one that no "}" ends.
    lasts = chunks.groupBy("file").agg(F.max(F.struct("start", "at")).alias("end")).select("file", "end.*", F.lit(True).alias("tail"))
    placed = placed.join(lasts, ["file", "start", "at"], "left").withColumn("tail", F.coalesce("tail", F.lit(False)))
    change = F.when(inside, F.col("odd")).otherwise(F.col("even")) - F.when(closes & ~F.col("tail"), 1).otherwise(0)
    placed = written(placed.withColumn("change", change).withColumn("closes", closes), "json-depths")
    placed = _running(placed, "change", "depth_before")
    ended = F.col("closes") & (F.col("depth_before") + F.col("change") == 0) & ~F.col("tail")
    placed = written(placed.withColumn("ended", ended.cast("long")), "json-ends")
    left = placed.groupBy("file").agg(
        F.sum("change").alias("depth"), F.sum("quotes").alias("quotes"), F.max(F.when(F.col("tail"), F.col("chunk"))).alias("end")
    )
    whole = (F.col("depth") == 0) & (F.col("quotes") % 2 == 0) & F.col("end").rlike(r"^[\s\[\],\x{FEFF}]*\][\s]*\z")
    if not left.filter(~whole).isEmpty():
        raise BrokenArray(f"a file under {path!r} is no whole JSON array")
    records = _running(placed, "ended", "record").filter(~F.col("tail")).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("start", "at", "chunk"))).alias("parts")  # the chunks of one record
    )
    text = F.concat(F.array_join(F.transform("parts", lambda x: x["chunk"]), "}"), F.lit("}"))
    record = F.regexp_replace(text, r"^[\s,\[\x{FEFF}]+", "")
    parsed = F.from_json(record, schema, {"mode": "FAILFAST" if on_bad == "fail" else "PERMISSIVE"})
    return records.select(parsed.alias("r")).select("r.*")
