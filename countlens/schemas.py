"""Table schemas of the count data mart.

Every field is nullable, as in the stored tables. Counts are declared ``int``
in storage (``narrow_id`` gives ``id`` that type too); sums of them widen to ``bigint`` in the reports unless a caller
asks for the narrow declared type.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Raw hourly counts, one row per sensor per hour. ``date_time`` is an ISO
# local date-time string ``yyyy-MM-ddTHH:mm:ss``. ``id`` is unique per row, so
# it is wide: there can be more rows than an int can number.
# Names and order of the stored columns.
SENSOR_COUNTS = StructType(
    [
        StructField("id", LongType(), True),
        StructField("date_time", StringType(), True),
        StructField("sensor_id", IntegerType(), True),
        StructField("sensor_name", StringType(), True),
        StructField("hourly_count", IntegerType(), True),
    ]
)

# Names, types and order of the stored columns.
# Sensor dimension; ``location_id`` is the key the counts' ``sensor_id`` points at.
SENSOR_REFERENCE = StructType(
    [
        StructField("location_id", IntegerType(), True),
        StructField("sensor_description", StringType(), True),
        StructField("sensor_name", StringType(), True),
        StructField("installation_date", StringType(), True),
        StructField("note", StringType(), True),
        StructField("location_type", StringType(), True),
        StructField("status", StringType(), True),
        StructField("direction_1", StringType(), True),
        StructField("direction_2", StringType(), True),
        StructField("latitude", DoubleType(), True),
        StructField("longitude", DoubleType(), True),
        StructField(
            "location",
            StructType(
                [
                    StructField("lon", DoubleType(), True),
                    StructField("lat", DoubleType(), True),
                ]
            ),
            True,
        ),
    ]
)

# Month partition column of the stored counts and the tables kept by month:
# the first seven characters (``yyyy-MM``) of ``date_time``.
MONTH_COL = "year_month"

# Stored day totals of the counts, partitioned like the month-partitioned
# counts: one row per (day, day text, sensor) with the sum and the raw row
# count. ``day_text`` is the stored time's first ten characters: it decides which
# period a row is in, also where ``day`` is NULL because the time is malformed.
SENSOR_DAY_TOTALS = StructType(
    [
        StructField("day", DateType(), True),
        StructField("day_text", StringType(), True),
        StructField("sensor_id", IntegerType(), True),
        StructField("total", LongType(), True),
        StructField("n_rows", LongType(), True),
        StructField("year_month", StringType(), True),
    ]
)

# Failures of the row-level checks of ``sensor_counts`` per month partition
# (they add up over months; see ``plans.jobs.refresh_check_failures``).
CHECK_FAILURES_BY_MONTH = StructType(
    [
        StructField("table_name", StringType(), True),
        StructField("column_name", StringType(), True),
        StructField("check_name", StringType(), True),
        StructField("failures", LongType(), True),
        StructField("year_month", StringType(), True),
    ]
)

# Ids that stand more than once in the stored counts, per month of their rows
# (see ``plans.jobs.refresh_duplicate_ids``).
DUPLICATE_IDS_BY_MONTH = StructType(
    [StructField("id", LongType(), True), StructField("year_month", StringType(), True)]
)

# Rows that fail a row-level check of ``sensor_counts``, once per check, by month.
FAILING_ROWS_BY_MONTH = StructType(
    [
        *SENSOR_COUNTS.fields,
        StructField("column_name", StringType(), True),
        StructField("check_name", StringType(), True),
        StructField(MONTH_COL, StringType(), True),
    ]
)

# Tables of ``plans.batches.CountMart``. Counts with the key of the file that landed them.
FILE_KEY = "file_key"
LANDED_COUNTS = StructType(
    [*SENSOR_COUNTS.fields, StructField(FILE_KEY, StringType(), True), StructField(MONTH_COL, StringType(), True)]
)

# Which partition holds an id or a file: bits of 64 ids to a row, and a row per file.
PARTITION_INDEX = StructType(
    [
        StructField("block", LongType(), True),
        StructField("bits", LongType(), True),
        StructField(FILE_KEY, StringType(), True),
        StructField(MONTH_COL, StringType(), True),
    ]
)

# Rows per id, kept by ranges of ids; the duplicates alone have the same columns.
ID_COUNTS = StructType(
    [StructField("id", LongType(), True), StructField("n", LongType(), True), StructField("id_range", StringType(), True)]
)

# Steps of the batches that a mart has taken.
BATCH_LEDGER = StructType(
    [
        StructField("batch_id", StringType(), True),
        StructField("number", LongType(), True),
        StructField("step", StringType(), True),
        StructField("detail", StringType(), True),
        StructField("at", TimestampType(), True),
    ]
)

# Partition column of the rankings kept by month: the month, or UNDATED.
PART_COL = "part"
UNDATED = "undated"
TOP_BY_DAY_BY_MONTH = StructType(
    [
        StructField("date", StringType(), True),
        StructField("rank", IntegerType(), True),
        StructField("sensor_id", IntegerType(), True),
        StructField("location_name", StringType(), True),
        StructField("daily_count", LongType(), True),
        StructField(PART_COL, StringType(), True),
    ]
)
TOP_BY_MONTH_BY_MONTH = StructType(
    [
        StructField("year_month", StringType(), True),
        StructField("rank", IntegerType(), True),
        StructField("sensor_id", IntegerType(), True),
        StructField("location_name", StringType(), True),
        StructField("monthly_count", LongType(), True),
        StructField(PART_COL, StringType(), True),
    ]
)

# Raw CSV header names of the count file (fixed values of the source format).
CSV_ID = "ID"
CSV_DATE_TIME = "Date_Time"
CSV_SENSOR_ID = "Sensor_ID"
CSV_SENSOR_NAME = "Sensor_Name"
CSV_HOURLY_COUNTS = "Hourly_Counts"


def narrow_id(schema: StructType) -> StructType:
    """``schema`` with an ``int`` column ``id``, for tables that declare it so."""
    return StructType([StructField("id", IntegerType(), True) if f.name == "id" else f for f in schema.fields])


def ddl(schema: StructType) -> str:
    """Column list for ``CREATE TABLE`` from a StructType."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
