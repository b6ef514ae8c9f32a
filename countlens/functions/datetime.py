"""Date-time column expressions (all JVM-side, codegen friendly).

Fixed values: the raw count file writes times as ``%B %d, %Y %I:%M:%S %p``
(e.g. ``November 01, 2019 05:00:00 PM``); stored tables hold ISO local
``%Y-%m-%dT%H:%M:%S``. Spark patterns below use single ``d``/``h`` so that
both one- and two-digit days and hours parse.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

# Source and storage formats.
RAW_COUNT_TIME_FORMAT = "MMMM d, yyyy h:mm:ss a"
RAW_COUNT_TIME_FORMAT_PADDED = "MMMM dd, yyyy hh:mm:ss a"
ISO_LOCAL_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def parse_local_time(
    c: Column | str, fmt: str, on_bad: str = "fail", spark: SparkSession | None = None
) -> Column:
    """Parse a string to ``timestamp_ntz`` with a Spark datetime pattern.

    ``on_bad="fail"`` raises on the first unparseable value (ANSI
    behaviour); ``on_bad="null"`` turns it into NULL so it can be
    quarantined / reported by a not_null check.
    """
    c = F.col(c) if isinstance(c, str) else c
    strict = F.to_timestamp_ntz(c, F.lit(fmt))
    if on_bad == "fail":
        if ansi_mode(spark):
            return strict  # the parse itself raises on a bad value
        # ANSI off: the parse would give NULL, so fail explicitly
        return fail_if(c.isNotNull() & strict.isNull(), strict, "unparseable time", c)
    if on_bad == "null":
        lenient = F.try_to_timestamp(c, F.lit(fmt))
        if session_zone_is_fixed(spark) and not _ZONE_LETTERS.search(fmt):
            return lenient.cast("timestamp_ntz")  # the wall clock as parsed: one parse a row
        # try_to_timestamp decides validity; the strict NTZ parse only runs
        # on rows that are known to parse, so the result is zone-free.
        return F.when(lenient.isNotNull(), strict)
    raise ValueError(f"on_bad must be 'fail' or 'null', not {on_bad!r}")


def _session(spark: SparkSession | None) -> SparkSession | None:
    # the given session, else this thread's active one (None in a thread
    # that did not create or activate a session)
    return spark if spark is not None else SparkSession.getActiveSession()


def ansi_mode(spark: SparkSession | None = None) -> bool:
    """Whether the session (given, else active) runs in ANSI mode.

    Casts and parses take their error behaviour from this setting when the
    expression is built, so deciding here, at the same moment, matches what
    Spark does: under ANSI a bad value already raises, otherwise it becomes
    NULL and only an explicit check (``fail_if``) can fail the job. With no
    session known the answer is False, whose explicit checks are right in
    either mode.
    """
    spark = _session(spark)
    if spark is None:
        return False
    return str(spark.conf.get("spark.sql.ansi.enabled", "true")).lower() == "true"


def fail_if(bad: Column, value: Column, what: str, source: Column) -> Column:
    """``value``, or a task error naming ``what`` and the ``source`` text
    on the first row where ``bad`` holds."""
    message = F.concat(F.lit(f"{what}: "), F.coalesce(source.cast("string"), F.lit("NULL")))
    return F.when(bad, F.raise_error(message)).otherwise(value)


_FIXED_OFFSET_ZONE = re.compile(
    r"^(Etc/)?(UTC|GMT|UCT|Universal|Zulu|Z)([+-]\d{1,2}(:\d{2})?)?$|^[+-]\d{1,2}(:\d{2})?$"
)


# Pattern letters of a zone or an offset in the text.
_ZONE_LETTERS = re.compile("[VvzOXxZ]")


def session_zone_is_fixed(spark: SparkSession | None = None) -> bool:
    """Whether the session's (given, else active) time zone is a fixed
    offset (e.g. UTC).

    Such a zone has no daylight-saving gaps, so ``date_format`` shows a
    ``timestamp_ntz`` exactly as its wall clock. Spark resolves the zone of
    a date-time expression when the expression is built, which is when
    this is asked. With no session known the answer is False, whose
    field-based formatting is right in any zone.
    """
    spark = _session(spark)
    if spark is None:
        return False
    return bool(_FIXED_OFFSET_ZONE.match(str(spark.conf.get("spark.sql.session.timeZone", ""))))


def format_iso(c: Column | str, spark: SparkSession | None = None) -> Column:
    """Format a date-time as ISO local ``yyyy-MM-ddTHH:mm:ss`` text.

    Independent of the session time zone: a ``timestamp_ntz`` keeps its
    wall clock even where ``date_format`` would pass it through a session
    zone with a daylight-saving gap (e.g. midnight on a day that starts at
    01:00). In a fixed-offset zone such as UTC ``date_format`` is exact and
    used; otherwise the text is taken from the timestamp's own text cast.
    A zoned ``timestamp`` shows the session's wall clock either way.
    """
    c = F.col(c) if isinstance(c, str) else c
    if session_zone_is_fixed(spark):
        return F.date_format(c, ISO_LOCAL_FORMAT)
    text = c.cast("timestamp_ntz").cast("string")  # yyyy-MM-dd HH:mm:ss[.ffffff]
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))


def as_local_time(df: DataFrame, name: str) -> Column:
    """The column ``name`` of ``df`` as ``timestamp_ntz``.

    Strings (ISO text as stored) are converted with ``try_cast`` so that a
    malformed value becomes NULL and forms its own NULL period, as a
    non-ANSI cast would; timestamps pass through.
    """
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, TimestampNTZType):
        return c
    if isinstance(dtype, (StringType,)):
        return c.try_cast("timestamp_ntz")
    if isinstance(dtype, (TimestampType, DateType)):
        return c.cast("timestamp_ntz")
    raise TypeError(f"column {name!r} has type {dtype.simpleString()}, not a date-time")


def day_of(df: DataFrame, name: str) -> Column:
    """Calendar day of a date-time column (``date``)."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, DateType):
        return F.col(name)
    return as_local_time(df, name).cast("date")


def day_text_of(df: DataFrame, name: str) -> Column:
    """The first ten characters of a text time as stored, or the day of a typed one as text.

    Compared with day bounds, it puts a row in the same periods as the whole
    text does, also when the text is no valid time.
    """
    if isinstance(df.schema[name].dataType, StringType):
        return F.col(name).substr(1, 10)
    return day_of(df, name).cast("string")


def month_of_day_text(c: Column | str) -> Column:
    """``yyyy-MM`` from ISO day or date-time text (its first seven characters)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.substr(1, 7)


def is_day(bound: str) -> bool:
    """Whether a period bound is a day alone (``yyyy-MM-dd``)."""
    return bool(re.fullmatch(r"\d{4}-\d{2}-\d{2}", bound))


def period_bound(df: DataFrame, name: str, value: str) -> Column:
    """A literal bound typed like column ``name`` so the comparison pushes down.

    ISO strings compare lexicographically, which orders them like time
    (``'2019-11-01T00:00:00' >= '2019-11-01'``); timestamp columns get a
    folded ``timestamp_ntz`` literal.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, StringType):
        return F.lit(value)
    if isinstance(dtype, DateType):
        return F.lit(value).cast("date")
    if isinstance(dtype, TimestampType):
        return F.lit(value).cast("timestamp")
    return F.lit(value).cast("timestamp_ntz")


def in_period(df: DataFrame, name: str, start: str, end: str) -> Column:
    """Half-open period test ``start <= name < end`` (NULL is outside).

    A ``date`` column stands for its midnight: against a bound with a time
    of day it is compared as ``timestamp_ntz``, so no bound is cut to a day.
    """
    c = F.col(name)
    if isinstance(df.schema[name].dataType, DateType) and not (is_day(start) and is_day(end)):
        midnight = c.cast("timestamp_ntz")
        return (midnight >= F.lit(start).cast("timestamp_ntz")) & (midnight < F.lit(end).cast("timestamp_ntz"))
    return (c >= period_bound(df, name, start)) & (c < period_bound(df, name, end))


def months_touching(month_col: str, start: str, end: str) -> Column:
    """``yyyy-MM`` keys that can hold rows of the period ``[start, end)``.

    A redundant predicate for tables partitioned by a month key derived from
    the time column: it implies nothing new about the rows but lets Spark
    prune whole partition folders before any file is opened. (The month of
    an exclusive ``end`` is kept; the exact time filter drops its rows.)
    """
    c = F.col(month_col)
    return (c >= F.lit(start[:7])) & (c <= F.lit(end[:7]))
