"""Declarative data-quality checks over stored tables.

A check names a column and a failure rule; zero failures means it passes.
``run_checks`` evaluates every row-level check of a table in a single
aggregation (one scan) and each ``unique`` check as one grouped count
(partial + final aggregate, so a value repeated on a third of the rows is
pre-counted per task before the shuffle). ``violations`` returns the failing
rows of one check, like a data test that selects offending records.

NULL handling follows the usual data-test contract: only ``not_null`` fails
on NULL; ``unique`` ignores NULL; value, format and range checks let NULL
pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns of the two format checks (``\\z``: a line break at the end fails).
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}\z"
ISO_PATTERN_OFFSET_REQUIRED = (
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?([+-]\d{2}:\d{2}|Z)\z"
)
ISO_PATTERN_OFFSET_OPTIONAL = (
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?([+-]\d{2}:\d{2}|Z)?\z"
)

# Accepted values of the sensor dimension.
LOCATION_TYPES = ("Indoor", "Outdoor", "Indoor Blix", "Outdoor Blix")
STATUSES = ("A",)
DIRECTIONS = ("North", "South", "East", "West", "In", "Out")

RESULT_SCHEMA = "table_name string, column_name string, check_name string, failures bigint"


@dataclass(frozen=True)
class Check:
    """One check: ``fails(col)`` is the row-level failure predicate.

    ``kind == "unique"`` has no row predicate; it is evaluated by grouping.
    """

    column: str
    name: str
    fails: Callable[[Column], Column] | None = field(default=None, compare=False)
    kind: str = "row"

    def failure(self) -> Column:
        if self.fails is None:
            raise ValueError(f"check {self.name!r} has no row predicate")
        return self.fails(F.col(self.column))


def not_null(column: str) -> Check:
    return Check(column, "not_null", lambda c: c.isNull())


def unique(column: str) -> Check:
    return Check(column, "unique", None, kind="unique")


def accepted_values(column: str, values: Sequence, name: str = "accepted_values") -> Check:
    vals = list(values)
    return Check(column, name, lambda c: c.isNotNull() & ~c.isin(vals))


def matches(column: str, pattern: str, name: str) -> Check:
    return Check(column, name, lambda c: c.isNotNull() & ~c.rlike(pattern))


def is_date_format(column: str) -> Check:
    return matches(column, DATE_PATTERN, "is_date_format")


def is_iso_format(column: str, require_offset: bool = False) -> Check:
    pattern = ISO_PATTERN_OFFSET_REQUIRED if require_offset else ISO_PATTERN_OFFSET_OPTIONAL
    return matches(column, pattern, "is_iso_format")


def non_negative(column: str) -> Check:
    return Check(column, "non_negative", lambda c: c < 0)


def in_range(column: str, low, high) -> Check:
    """Value must lie in the half-open range ``[low, high)``."""
    return Check(column, "in_range", lambda c: (c < F.lit(low)) | (c >= F.lit(high)))


def custom(column: str, name: str, fails: Callable[[Column], Column]) -> Check:
    """User-defined row check: ``fails`` maps the column to a failure predicate."""
    return Check(column, name, fails)


# Check specs of the three tested tables.
def sensor_counts_checks(require_iso_offset: bool = False) -> list[Check]:
    return [
        unique("id"),
        not_null("id"),
        not_null("date_time"),
        is_iso_format("date_time", require_offset=require_iso_offset),
        not_null("sensor_id"),
        not_null("sensor_name"),
        not_null("hourly_count"),
        non_negative("hourly_count"),
        in_range("sensor_id", 0, 1000),
    ]


def sensor_reference_checks() -> list[Check]:
    return [
        not_null("location_id"),
        unique("location_id"),
        not_null("sensor_description"),
        is_date_format("installation_date"),
        not_null("location_type"),
        accepted_values("location_type", LOCATION_TYPES),
        not_null("status"),
        accepted_values("status", STATUSES),
        accepted_values("direction_1", DIRECTIONS),
        accepted_values("direction_2", DIRECTIONS),
        not_null("latitude"),
        not_null("longitude"),
    ]


def top_n_by_day_checks(n: int = 10) -> list[Check]:
    return [
        not_null("date"),
        is_date_format("date"),
        not_null("rank"),
        accepted_values("rank", range(1, n + 1), name="rank_range"),
        not_null("sensor_id"),
        not_null("daily_count"),
    ]


def _unique_failures(df: DataFrame, check: Check, table_name: str) -> DataFrame:
    c = F.col(check.column)
    dup_values = (
        df.select(c.alias("__v"))
        .filter(F.col("__v").isNotNull())
        .groupBy("__v")
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") > 1)
    )
    return dup_values.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table_name).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.name).alias("check_name"),
        F.col("failures").cast("bigint").alias("failures"),
    )


def run_checks(
    df: DataFrame, checks: Sequence[Check], table_name: str = "", by: Sequence[str] = ()
) -> DataFrame:
    """One row per check: ``table_name, column_name, check_name, failures``.

    All row-level checks share one scan and one global aggregate (the
    partial counts are summed from one row per task); every ``unique``
    check adds one grouped count. Nothing is collected.

    ``by``: columns to count failures per group of (e.g. a month partition
    column), giving one row per group and check with the ``by`` columns
    first. Row-check failures add up over groups, so per-group counts can
    be kept and summed later; ``unique`` does not add up and is refused.
    """
    row_checks = [ch for ch in checks if ch.kind == "row"]
    if by and len(row_checks) < len(checks):
        raise ValueError("unique checks cannot be counted per group")
    parts: list[DataFrame] = []
    if row_checks:
        aggs = [F.count_if(ch.failure()).alias(f"__c{i}") for i, ch in enumerate(row_checks)]
        counts = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
        rows = F.array(
            *[
                F.struct(
                    F.lit(table_name).alias("table_name"),
                    F.lit(ch.column).alias("column_name"),
                    F.lit(ch.name).alias("check_name"),
                    F.col(f"__c{i}").cast("bigint").alias("failures"),
                )
                for i, ch in enumerate(row_checks)
            ]
        )
        parts.append(counts.select(*by, F.inline(rows)))
    for ch in checks:
        if ch.kind == "unique":
            parts.append(_unique_failures(df, ch, table_name))
    if not parts:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def violations(df: DataFrame, check: Check) -> DataFrame:
    """Failing records of one check.

    Row checks return the offending rows. ``unique`` returns each repeated
    value with its number of records (``value, n_records``), which is what
    a reviewer needs and stays bounded by the number of distinct values.
    """
    if check.kind == "unique":
        c = F.col(check.column)
        return (
            df.filter(c.isNotNull())
            .groupBy(c.alias("value"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1)
        )
    return df.filter(check.failure())


def failing_rows(df: DataFrame, checks: Sequence[Check], keep: Sequence[str] = ()) -> DataFrame:
    """Each failing row of each row-level check: the columns ``keep`` (none named: all), ``column_name``, ``check_name``.

    One scan for all checks, each of which is evaluated once a row: a row is spread over
    its checks, and what it does not fail is dropped. The same rows as one
    ``violations`` per check. ``unique`` is no check of a row and is refused.
    """
    if any(ch.kind != "row" for ch in checks):
        raise ValueError("unique has no failing row of its own; see violations")
    keep = list(keep) or df.columns
    told = [F.struct(F.lit(ch.column).alias("column_name"), F.lit(ch.name).alias("check_name")) for ch in checks]
    if not told:
        return df.select(*keep, F.lit("").alias("column_name"), F.lit("").alias("check_name")).limit(0)
    failed = F.array(*[F.when(ch.failure(), t) for ch, t in zip(checks, told, strict=True)])
    return df.select(*keep, F.inline(failed)).filter(F.col("check_name").isNotNull())


def all_pass(results: DataFrame) -> Column:
    """Aggregate expression over ``run_checks`` output: true when nothing failed."""
    return F.coalesce(F.max(F.col("failures")), F.lit(0)) == 0


class ChecksFailed(Exception):
    """Raised by ``gate``; ``failed`` lists (table, column, check, failures)."""

    def __init__(self, failed: list[tuple[str, str, str, int]]):
        self.failed = failed
        listed = "; ".join(f"{t}.{c} {name}: {n}" for t, c, name, n in failed)
        super().__init__(f"{len(failed)} checks failed: {listed}")


def gate(results: DataFrame) -> None:
    """Run the checks of ``run_checks`` output and raise ``ChecksFailed`` if any fails.

    Only the failed checks' rows (one per check) reach the driver.
    """
    failed = results.filter(F.col("failures") > 0).orderBy("table_name", "column_name", "check_name").collect()
    if failed:
        raise ChecksFailed([tuple(r) for r in failed])
