"""File sources: the raw count CSV, the sensor JSON, and stored tables.

All reads are distributed scans; the driver only ever reads the CSV header
line (to learn column names) and never holds data.
"""

from __future__ import annotations

import csv
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from countlens import schemas
from countlens.functions.datetime import (
    RAW_COUNT_TIME_FORMAT,
    ansi_mode,
    fail_if,
    format_iso,
    month_of_day_text,
    parse_local_time,
)

RAW_COUNT_COLUMNS = (
    schemas.CSV_ID,
    schemas.CSV_DATE_TIME,
    schemas.CSV_SENSOR_ID,
    schemas.CSV_SENSOR_NAME,
    schemas.CSV_HOURLY_COUNTS,
)


# Month key prefix of rows whose time did not parse (see ``with_month``).
UNPARSED_PREFIX = "unparsed-"

# Column of the raw reads that holds a line with too few or too many fields.
BAD_LINE = "__bad_line"


def _to_int(c, on_bad: str, spark=None, type_name: str = "int"):
    if on_bad == "null":
        return c.try_cast(type_name)
    if ansi_mode(spark):
        return c.cast(type_name)  # raises on a bad value
    # ANSI off: the cast would give NULL, so fail explicitly
    value = c.try_cast(type_name)
    return fail_if(c.isNotNull() & value.isNull(), value, f"not of type {type_name}", c)


def counts_from_raw(
    raw: DataFrame,
    on_bad: str = "fail",
    time_format: str = RAW_COUNT_TIME_FORMAT,
    extra: tuple = (),
    id_type: str = "bigint",
    bad_line_col: str | None = None,
) -> DataFrame:
    """Type and rename raw count columns (selected *by header name*).

    ``ID, Date_Time, Sensor_ID, Sensor_Name, Hourly_Counts`` become
    ``id bigint, date_time string (ISO local), sensor_id int, sensor_name
    string, hourly_count int``; other columns are ignored.
    ``on_bad="fail"`` raises on a malformed time or number, on an empty field
    of the five, and on a line with too few or too many fields.
    ``on_bad="null"`` keeps each such row, with NULL for what is malformed or
    missing; ``bad_line_col`` then names a column for the text of a line with a
    wrong number of fields, for quarantine. ``id_type``: ``"int"`` for tables
    that declare the narrow type. ``extra``: further columns of ``raw`` (or
    expressions over it) to keep after the typed ones.
    """
    if on_bad not in ("fail", "null"):
        raise ValueError(f"on_bad must be 'fail' or 'null', not {on_bad!r}")
    c = F.col
    spark = raw.sparkSession  # its settings decide how errors and times are handled
    bad_line = c(BAD_LINE) if BAD_LINE in raw.columns else F.lit(None).cast("string")
    if on_bad == "fail":
        raw = raw.filter(_sound(bad_line))
    parsed = parse_local_time(c(schemas.CSV_DATE_TIME), time_format, on_bad, spark)
    kept = [bad_line.alias(bad_line_col)] if bad_line_col else []
    return raw.select(
        _to_int(c(schemas.CSV_ID), on_bad, spark, id_type).alias("id"),
        format_iso(parsed, spark).alias("date_time"),
        _to_int(c(schemas.CSV_SENSOR_ID), on_bad, spark).alias("sensor_id"),
        c(schemas.CSV_SENSOR_NAME).cast("string").alias("sensor_name"),
        _to_int(c(schemas.CSV_HOURLY_COUNTS), on_bad, spark).alias("hourly_count"),
        *kept,
        *extra,
    )


def _sound(bad_line):
    """A filter that raises on a malformed line or an empty field. As a filter
    it is evaluated whatever columns a reader of the result picks."""
    empty = F.lit(None).cast("string")
    for name in RAW_COUNT_COLUMNS:
        empty = F.coalesce(empty, F.when(F.col(name).isNull(), F.lit(f"empty {name}")))
    problem = F.coalesce(F.concat(F.lit("wrong number of fields: "), bad_line), empty)
    return F.when(problem.isNotNull(), F.raise_error(problem).cast("boolean")).otherwise(F.lit(True))


def read_counts_csv(
    spark: SparkSession,
    path: str,
    on_bad: str = "fail",
    time_format: str = RAW_COUNT_TIME_FORMAT,
    mixed_headers: bool = False,
    id_type: str = "bigint",
    bad_line_col: str | None = None,
) -> DataFrame:
    """Read header CSV file(s) of hourly counts into the ``sensor_counts`` shape.

    Columns are read as text (no schema inference pass over the data) and
    cast explicitly. Plain and bzip2 CSV split across tasks, gzip is one task
    per file (land many files); a ``.zip`` archive must be landed unzipped.
    """
    raw = read_raw_counts_csv(spark, path, mixed_headers)
    return counts_from_raw(raw, on_bad, time_format, id_type=id_type, bad_line_col=bad_line_col)


def read_raw_counts_csv(spark: SparkSession, path: str, mixed_headers: bool = False) -> DataFrame:
    """Header CSV file(s) of counts as text columns, with ``BAD_LINE``.

    Every file's header is compared with the first file's, and a file whose
    columns have other names or another order fails the job. With
    ``mixed_headers=True`` files are grouped by header and united by column
    name instead; finding the headers takes a pass over the files' text.
    """
    if not mixed_headers:
        header = spark.read.option("header", True).csv(path).columns
        return _with_header(spark, header, path)
    name = F.col("_metadata.file_path")
    lines = spark.read.text(path).select(name.alias("file"), F.monotonically_increasing_id().alias("at"), "value")
    for column in RAW_COUNT_COLUMNS:
        lines = lines.filter(F.col("value").contains(column))
    headers = lines.groupBy("file").agg(F.min(F.struct("at", "value")).alias("first"))
    # One list of files per header: as much as Spark lists to plan the scan.
    groups = headers.groupBy(F.col("first.value").alias("header")).agg(F.collect_list("file").alias("files")).collect()
    if not groups:
        raise ValueError(f"no file under {path!r} has a header with {', '.join(RAW_COUNT_COLUMNS)}")
    listed = sum(len(g["files"]) for g in groups)
    if listed < len(spark.read.text(path).inputFiles()):
        raise ValueError(f"{path!r} holds files without a header with {', '.join(RAW_COUNT_COLUMNS)}")
    out = None
    for group in sorted(groups):
        files = [unquote(f) for f in sorted(group["files"])]
        header = next(csv.reader([group["header"]]))
        part = _with_header(spark, header, files).select(*RAW_COUNT_COLUMNS, BAD_LINE, "_metadata")
        out = part if out is None else out.unionByName(part)
    return out


def _with_header(spark: SparkSession, header: list[str], path: str | list[str]) -> DataFrame:
    schema = raw_counts_schema([*header, BAD_LINE])
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    # Without pruning, every line is parsed whole and its fields are counted.
    return reader.option("columnPruning", False).option("columnNameOfCorruptRecord", BAD_LINE).csv(path)


def with_month(typed: DataFrame, file_col: str = "__file", keep_key: bool = False) -> DataFrame:
    """Typed counts with the ``year_month`` partition column in place of their source file.

    A row whose time does not parse (kept as NULL with ``on_bad="null"``) has
    no month; it is keyed by its source file (``unparsed-<hash of the path>``),
    so landing a file again replaces that file's unparsed rows and never
    another's. ``keep_key``: also keep that hash, of every row, as ``file_key``. ``file_col``
    holds the path as text or as its UTF-8 bytes.
    """
    key = F.sha2(F.col(file_col), 256)
    unparsed = F.concat(F.lit(UNPARSED_PREFIX), key)
    out = typed.withColumn(schemas.MONTH_COL, F.coalesce(month_of_day_text("date_time"), unparsed))
    return (out.withColumn(schemas.FILE_KEY, key) if keep_key else out).drop(file_col)


def raw_counts_schema(columns=RAW_COUNT_COLUMNS) -> StructType:
    """All-text schema of a count file with the given header (for streaming)."""
    return StructType([StructField(name, StringType(), True) for name in columns])


def read_reference_json(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    schema: StructType = schemas.SENSOR_REFERENCE,
    on_bad: str = "fail",
) -> DataFrame:
    """Read sensor records with the declared schema (never inferred).

    ``multi_line=False`` reads JSON Lines, which splits across tasks and is
    the layout to land at scale; ``multi_line=True`` reads a JSON array
    document (one file per task). Inference is avoided because it would type
    ``location_id`` as bigint and ``location`` as a map. ``on_bad="fail"``
    raises on a record that is no JSON or has a value of another type;
    ``on_bad="null"`` keeps the record with NULL there.
    """
    if on_bad not in ("fail", "null"):
        raise ValueError(f"on_bad must be 'fail' or 'null', not {on_bad!r}")
    mode = "FAILFAST" if on_bad == "fail" else "PERMISSIVE"
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", mode).json(path)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A stored table by catalog name, or a Parquet folder by path."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)
