"""Places of rows in an order, also where one group holds most rows.

A window gathers each of its groups in one task. Here rows are sorted by
ranges of (group, order) instead, so a large group lies in many partitions one
after the other, and a row's place is its place within its partition's share of
the group plus the sizes of the group's earlier shares. Only those sizes, one
row per group and partition, are ever windowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countlens.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh folder below the shared checkpoint folder, and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def placed(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], place: str = "place", total: str = "group_rows"
) -> DataFrame:
    """``df`` with each row's place (from 0) in ``order`` within its group ``by``, and the group's rows.

    A null in ``by`` is a group like any other. Rows that are equal in ``order``
    get consecutive places, in no stated order among them: give an order that
    tells them apart where it matters. The sorted rows are written once (it runs
    jobs), so that places don't change between reads; their partitions are
    ranges of the whole order, so no partition holds more than its share unless
    more rows than that are equal in all of ``by`` and ``order``. Rows are then
    joined with their share's offset by (share, group), which no hot group makes
    uneven. ``df`` is read twice, so let it be narrow, or a stored table.
    """
    clash = {"__at", "__share", "__first", "__before", "__rows"} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} have names that are used inside")
    keys = [F.col(c).asc_nulls_first() for c in by] + list(order)
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = written(ordered.withColumn("__at", F.monotonically_increasing_id()), "ordered")
    ordered = ordered.withColumn("__share", F.shiftright("__at", 33))
    shares = ordered.groupBy("__share", *by).agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("__share").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select(
        "__share", *by, "__first",
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__rows").over(group).alias("__rows"),
    ).alias("s")
    same = F.col("r.__share") == F.col("s.__share")
    for c in by:
        same = same & F.col(f"r.`{c}`").eqNullSafe(F.col(f"s.`{c}`"))
    at = F.col("s.__before") + F.col("r.__at") - F.col("s.__first")
    kept = [F.col(f"r.`{c}`") for c in df.columns]
    return ordered.alias("r").join(shares, same).select(*kept, at.alias(place), F.col("s.__rows").alias(total))
