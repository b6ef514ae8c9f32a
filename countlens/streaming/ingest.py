"""Incremental count ingest with Structured Streaming.

The batch ingest re-reads the whole count file on every run. For count
files that keep landing in a folder, this runs the same typing step as a
file stream: each new file is read once, typed, and appended to the Parquet
table. Progress lives in the checkpoint folder, so a restarted or failed
run resumes exactly where it stopped (the file sink commits each batch
atomically through its metadata log).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from countlens.functions.datetime import RAW_COUNT_TIME_FORMAT
from countlens.plans.batches import CountMart
from countlens.schemas import MONTH_COL
from countlens.sources.files import (
    BAD_LINE,
    RAW_COUNT_COLUMNS,
    counts_from_raw,
    raw_counts_schema,
    with_month,
)


def stream_counts_csv(
    spark: SparkSession,
    landing_dir: str,
    out_path: str,
    checkpoint_path: str,
    raw_columns=RAW_COUNT_COLUMNS,
    on_bad: str = "null",
    time_format: str = RAW_COUNT_TIME_FORMAT,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    by_month: bool = False,
) -> StreamingQuery:
    """Start a stream from header CSV files in ``landing_dir`` to Parquet.

    ``raw_columns`` is the file header in order (a file stream needs its
    schema up front). ``available_now=True`` processes everything present
    and stops (a scheduled incremental batch); otherwise it keeps running.
    ``on_bad`` defaults to ``"null"`` so one malformed row cannot stop the
    stream; the not_null check on ``date_time`` reports it. ``by_month``
    adds the ``year_month`` column and writes the output partitioned by it
    (the month layout of ``plans.jobs``), so readers prune months; this stream
    only appends, so each month folder gains files as counts arrive
    (``stream_counts_into`` merges instead).
    """
    reader = _reader(spark, raw_columns, max_files_per_trigger)
    source = (F.col("_metadata.file_path").alias("__file"),) if by_month else ()
    typed = counts_from_raw(reader.csv(landing_dir), on_bad, time_format, extra=source)
    if by_month:
        typed = with_month(typed)
    writer = (
        typed.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
    )
    if by_month:
        writer = writer.partitionBy(MONTH_COL)
    return _started(writer, available_now)


def _reader(spark: SparkSession, raw_columns, max_files_per_trigger: int | None):
    reader = (
        spark.readStream.schema(raw_counts_schema([*raw_columns, BAD_LINE]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", BAD_LINE)
    )
    return reader.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else reader


def _started(writer, available_now: bool) -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return writer.trigger(**trigger).start()


def stream_counts_into(
    mart: CountMart,
    landing_dir: str,
    checkpoint_path: str,
    raw_columns=RAW_COUNT_COLUMNS,
    on_bad: str = "null",
    time_format: str = RAW_COUNT_TIME_FORMAT,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    name: str = "stream",
) -> StreamingQuery:
    """Start a stream that merges landing count files into a ``CountMart``, a batch of the mart a micro-batch.

    The mart's ledger knows each micro-batch by ``name`` and number, so one that is
    delivered again after a failure is completed or passed over, and changes nothing
    twice. Rows replace those with their id, so a corrected file lands under a new
    name (a file stream reads a path once) and its rows take the old ones' place; to
    replace all rows of a file, also those it no longer has, use ``CountMart.apply``.
    ``name`` must be the stream's own, and stay with its checkpoint.
    """
    reader = _reader(mart.spark, raw_columns, max_files_per_trigger)
    source = (F.col("_metadata.file_path").alias("__file"),)
    typed = with_month(counts_from_raw(reader.csv(landing_dir), on_bad, time_format, extra=source), keep_key=True)

    def merge(rows: DataFrame, number: int) -> None:
        mart.apply_rows(f"{name}-{number}", rows)

    writer = typed.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_path)
    return _started(writer, available_now)
