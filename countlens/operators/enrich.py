"""Labelling facts from the sensor dimension (left outer equi-join).

A fact whose key has no dimension row keeps a NULL label. A duplicated
dimension key multiplies fact rows; that is left visible on purpose and is
what the ``unique`` check on the dimension key guards against.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

# Default bounds of ``bounded_broadcast``: half a million narrow rows / 64 MiB
# stay well under the broadcast limits of a default executor.
DEFAULT_BROADCAST_MAX_ROWS = 500_000
DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def _row_bytes(df: DataFrame):
    """Per-row size estimate: text/binary lengths plus 8 bytes per other column."""
    parts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + F.lit(8))
        else:
            parts.append(F.lit(8))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def measured_size(df: DataFrame) -> tuple[int, int]:
    """``(rows, bytes)`` of ``df`` now, measured by one distributed aggregate.

    Every task counts its rows and bytes and only one partial row per task
    reaches the final sum; two numbers reach the driver.
    """
    probe = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).collect()[0]
    return int(probe.n), int(probe.b or 0)


def within_bounds(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (and ``max_bytes`` bytes)."""
    rows, size = measured_size(df)
    return rows <= max_rows and (max_bytes is None or size <= max_bytes)


def bounded_broadcast(
    df: DataFrame,
    max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    max_bytes: int | None = DEFAULT_BROADCAST_MAX_BYTES,
) -> DataFrame:
    """``broadcast(df)`` when its size, measured now, is within the bounds, else ``df``.

    This runs a job at once; call it where a plan must have a broadcast that
    Spark would not choose by itself. The reports do not need it.
    """
    return F.broadcast(df) if within_bounds(df, max_rows, max_bytes) else df


def with_label(
    facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, label_col: str, out_col: str
) -> DataFrame:
    """Left-join ``dim[label_col]`` onto ``facts`` as ``out_col``.

    Only the key and label columns of the dimension are read (the projection
    is applied before the join so it reaches the dimension scan). Building
    the join runs nothing: whether the dimension is broadcast follows from
    Spark's own thresholds, by file sizes when planning and by measured
    shuffle sizes when running, so a dimension that outgrew them is shuffled.
    """
    return label_join(facts, dim, fact_key, dim_key, label_col, out_col).drop("__dim_key")


def label_join(
    facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, label_col: str, out_col: str
) -> DataFrame:
    """``with_label`` that keeps the dimension key as ``__dim_key``
    (for callers that project their output anyway)."""
    side = dim.select(F.col(dim_key).alias("__dim_key"), F.col(label_col).alias(out_col))
    return facts.join(side, F.col(fact_key) == F.col("__dim_key"), "left")
