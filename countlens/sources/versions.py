"""Versions of published tables: what is stored, and removal of what no reader should need.

``publish_table`` writes each version to a folder of its own. A version is
superseded when the next one is written; a reader that opened it before may go
on reading it. ``expire_versions`` removes the versions that were superseded
longer ago than a bound that readers keep, never the live one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from countlens.sources.tables import _for_table


def _folder(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name.replace('.', '/')}"


def _plain(path: str) -> str:
    """A location without the spelling of its scheme (``file:///`` and ``file:/`` are one)."""
    return "/" + path.split(":", 1)[-1].strip("/") if ":" in path else "/" + path.strip("/")


def table_versions(spark: SparkSession, name: str, root: str) -> DataFrame:
    """(``location``, ``n_files``, ``bytes``, ``written``, ``superseded``, ``live``) of each stored version of a
    table that ``publish_table`` wrote below ``root``; ``superseded`` is null for the newest."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(_folder(root, name))
    location = F.regexp_extract("path", r"^(.*/version=[^/]+)/", 1).alias("location")
    found = files.select(location, "modificationTime", "length").filter("location <> ''")
    found = found.groupBy("location").agg(
        F.count("*").alias("n_files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("written")
    )
    _, _, live = _for_table(spark.table(name).limit(0), name)
    suffix = _plain(live).rsplit("/", 1)[-1]
    # A row per version of one table.
    following = F.lead("written").over(Window.orderBy("written", "location"))
    return found.withColumn("superseded", following).withColumn("live", F.col("location").endswith("/" + suffix))


def expire_versions(spark: SparkSession, name: str, root: str, keep_seconds: float) -> list[str]:
    """Remove the versions of ``name`` below ``root`` that were superseded more than ``keep_seconds`` ago.

    ``keep_seconds`` must be more than the longest read of the table takes. The
    live version stays whatever its age, also when a later publish failed and left
    its folder. Returns the removed locations.
    """
    if keep_seconds < 0:
        raise ValueError("keep_seconds must not be negative")
    _, _, live = _for_table(spark.table(name).limit(0), name)
    if not _plain(live).startswith(_plain(_folder(root, name)) + "/version="):
        raise ValueError(f"the live version of {name!r} is not below {root!r}")
    age = F.unix_micros(F.current_timestamp()) - F.unix_micros("superseded")
    old = table_versions(spark, name, root).filter(~F.col("live") & (age > int(keep_seconds * 1_000_000)))
    gone = sorted(r["location"] for r in old.select("location").collect())
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for location in gone:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
        path.getFileSystem(conf).delete(path, True)
    return gone
