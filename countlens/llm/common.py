"""Reading tables and cutting lineage for the operators of this subpackage."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countlens.session import scratch_path


def importable(spark: SparkSession) -> None:
    """Let Python workers started from here on import this package from where the driver has it.

    On a cluster the package is installed or shipped (``--py-files``); there, the path adds nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to a fresh folder below the shared checkpoint folder and read it back.

    The files outlive any executor, so later stages never recompute what is
    above, even when the rows came from tasks that don't repeat exactly.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(schema).parquet(path)


def parts(rows_or_bytes: float, each: float, least: int = 1) -> int:
    """How many partitions hold ``each`` apiece."""
    return max(least, -(-int(rows_or_bytes) // int(each)))


#: Bits of a bitmap: 8 MB, whatever the data.
BITMAP_BITS = 26


def bitmap(df: DataFrame, name: str) -> np.ndarray:
    """Which values of a long column occur, by their lowest bits.

    A bitmap of a fixed size is broadcast to skip, in a pass over the texts,
    nearly all rows that a join would drop; the join still decides, so a
    bitmap that large data fills up costs time and nothing else.
    """
    word = F.shiftright(F.col(name).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)), 6).alias("word")
    bit = F.expr(f"shiftleft(1L, cast(`{name}` & 63 as int))").alias("bits")
    found = df.select(word, bit).groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint64)


def in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    k = values.view(np.uint64) & np.uint64((1 << BITMAP_BITS) - 1)
    return ((bits[(k >> np.uint64(6)).astype(np.int64)] >> (k & np.uint64(63))) & np.uint64(1)).astype(bool)
