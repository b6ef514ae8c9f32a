"""Landing count files with a quarantine: good rows, bad lines with their reasons, and counts per file.

One pass over the files writes one table, partitioned by whether a line is
good, so every line of every file is in exactly one of the two. The counts are
taken from what was written, and a gate on the share of bad lines decides
whether the landing is used. Bad lines are kept whole: as the reader's text
where the number of fields is wrong, else as their fields.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countlens import schemas
from countlens.functions.datetime import RAW_COUNT_TIME_FORMAT, parse_local_time
from countlens.sources.files import BAD_LINE, RAW_COUNT_COLUMNS, counts_from_raw, read_raw_counts_csv, with_month


class TooManyBadLines(Exception):
    """Raised when the share of bad lines exceeds the bound; nothing has been merged anywhere."""


@dataclass(frozen=True)
class Landing:
    """``good``: typed rows with their month and file key, as ``CountMart.apply_rows`` takes them.
    ``bad``: ``file``, ``reason``, ``line``, ``fields``. ``counts``: ``file``, ``reason`` (null: good),
    ``n_lines``."""

    good: DataFrame
    bad: DataFrame
    counts: DataFrame


def line_faults(time_format: str = RAW_COUNT_TIME_FORMAT, id_type: str = "bigint") -> Column:
    """What is wrong with a raw line, ``; `` between faults; null if nothing is."""
    types = {schemas.CSV_ID: id_type, schemas.CSV_SENSOR_ID: "int", schemas.CSV_HOURLY_COUNTS: "int"}
    empty, malformed = [], []
    for name in RAW_COUNT_COLUMNS:
        c = F.col(name)
        empty.append(F.when(c.isNull(), F.lit(f"empty {name}")))
        if name == schemas.CSV_DATE_TIME:
            value = parse_local_time(c, time_format, "null")
        elif name in types:
            value = c.try_cast(types[name])
        else:
            continue
        malformed.append(F.when(c.isNotNull() & value.isNull(), F.lit(f"malformed {name}")))
    listed = F.concat_ws("; ", *empty, *malformed)
    wrong = F.when(F.col(BAD_LINE).isNotNull(), F.lit("wrong number of fields"))
    return F.coalesce(wrong, F.when(listed != "", listed))


def land_with_quarantine(
    spark: SparkSession,
    csv_path: str,
    location: str,
    max_bad_share: float | None = None,
    mixed_headers: bool = False,
) -> Landing:
    """Land count files below ``location``; raises ``TooManyBadLines`` above ``max_bad_share`` (of all lines)."""
    raw = read_raw_counts_csv(spark, csv_path, mixed_headers).withColumn("__file", F.col("_metadata.file_path"))
    raw = raw.withColumn("__reason", line_faults())
    fields = F.array(*[F.col(c) for c in RAW_COUNT_COLUMNS])
    extra = (
        F.col("__file"),
        F.col("__file").alias("file"),
        F.col("__reason").alias("reason"),
        F.when(F.col("__reason").isNotNull(), F.col(BAD_LINE)).alias("line"),
        F.when(F.col("__reason").isNotNull(), fields).alias("fields"),
    )
    typed = with_month(counts_from_raw(raw, "null", extra=extra), keep_key=True)
    path = f"{location.rstrip('/')}/lines"
    # The month is a plain column here: the only folders are those of good and bad lines.
    typed.withColumn("good", F.col("reason").isNull()).write.partitionBy("good").parquet(path)
    lines = spark.read.schema(typed.schema.add("good", "boolean")).parquet(path)
    counts = lines.groupBy("file", "reason").agg(F.count("*").alias("n_lines"))
    if max_bad_share is not None:
        n, bad = lines.agg(F.count("*"), F.count("reason")).first()
        if bad > max_bad_share * n:
            raise TooManyBadLines(f"{bad} of {n} lines under {csv_path!r} are bad")
    good = lines.filter("good").select(*schemas.LANDED_COUNTS.names)
    bad = lines.filter("not good").select("file", "reason", "line", "fields")
    return Landing(good, bad, counts)
