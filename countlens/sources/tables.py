"""Catalog tables and sinks: register, overwrite, publish, view, preview."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from countlens.schemas import ddl


def _quote(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ensure_database(spark: SparkSession, table: str, root: str | None = None) -> None:
    """Create the table's database if needed (under ``root`` when given)."""
    if "." in table:
        db = table.rsplit(".", 1)[0]
        where = f" LOCATION {_text(root.rstrip('/') + '/' + db + '.db')}" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quote(db)}{where}")


def register_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    location: str,
    partition_by: list[str] | None = None,
) -> None:
    """Create an external Parquet table at ``location`` unless it exists.

    Idempotent: an existing table (and its data) is left as it is; if its
    columns or their types differ from ``schema``, it is refused.
    ``partition_by`` names columns of ``schema`` that become directory
    partitions (readers then prune them from filters on those columns).
    """
    _ensure_database(spark, name)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quote(name)} ({ddl(schema)}) "
        f"USING parquet{parts} LOCATION {_text(location)}"
    )
    known = spark.table(name).schema
    if not _same_columns(known, schema):
        raise ValueError(f"table {name!r} exists with columns {ddl(known)}, not {ddl(schema)}")


def overwrite_path(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full refresh of a Parquet folder (the folder is replaced by the new data,
    also when partitioned: the write option overrides a session set to
    dynamic partition overwrite)."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def overwrite_table(df: DataFrame, name: str) -> None:
    """Full refresh of a registered table: its folder is replaced, then its partitions listed anew.

    Columns are matched to the table *by name*. ``df`` must not read the
    table it overwrites. No session setting is changed.
    """
    out, part_cols, location = _for_table(df, name)
    overwrite_path(out, location, part_cols)
    _refresh(df.sparkSession, name, "SYNC" if part_cols else None)


def overwrite_partitions(
    df: DataFrame,
    name: str,
    sort_by: tuple[str, ...] = (),
    partitions: Sequence[str] | None = None,
    empty: Sequence[str] = (),
    regroup: bool = True,
) -> None:
    """Replace only the partitions of table ``name`` that ``df`` holds rows for.

    Dynamic partition overwrite: partitions absent from ``df`` are kept, so
    re-landing one month of counts rewrites that month and nothing else; each
    partition is written to a staging folder and moved in at commit, so ``df``
    may read the table. Rows are regrouped by partition (AQE merges small ones
    and splits a hot one), so the number of files follows the data and not
    tasks times partitions, and sorted once, by partition and ``sort_by``. The
    mode is an option of this write; no session setting is changed.

    For a table with one partition column: ``partitions`` names those that
    ``df`` may hold, which are then added to the catalog by name instead of by a
    listing of the table's folders; ``empty`` names partitions that lose all their
    rows, which a dynamic overwrite alone would leave as they are.

    ``regroup=False``: for rows whose tasks hold few partitions each, such as rows
    picked from a table with the same partitions; they are written without a shuffle.
    """
    out, part_cols, location = _for_table(df, name)
    if part_cols:
        out = out.hint("rebalance", *part_cols) if regroup else out
        out = out.sortWithinPartitions(*part_cols, *sort_by)
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*part_cols) if part_cols else writer).parquet(location)
    if partitions is None:
        _refresh(df.sparkSession, name, "ADD" if part_cols else None)
    else:
        _add_partitions(df.sparkSession, name, part_cols, [p for p in partitions if p not in set(empty)])
    if empty:
        empty_partitions(df.sparkSession, name, empty)


def _add_partitions(spark: SparkSession, name: str, part_cols: list[str], values: Sequence[str]) -> None:
    (column,) = part_cols
    for lo in range(0, len(values), 500):
        listed = " ".join(f"PARTITION (`{column}` = {_text(str(v))})" for v in values[lo : lo + 500])
        spark.sql(f"ALTER TABLE {_quote(name)} ADD IF NOT EXISTS {listed}")
    spark.sql(f"REFRESH TABLE {_quote(name)}")


def listed_partitions(spark: SparkSession, name: str) -> set[str]:
    """The values of a table's one partition column that the catalog lists."""
    return {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {_quote(name)}").collect()}


def empty_partitions(spark: SparkSession, name: str, values: Sequence[str]) -> None:
    """Take all rows from partitions of a table with one partition column (the partitions stay listed)."""
    none = spark.table(name).limit(0)
    _, (column,), location = _for_table(none, name)
    none = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in none.schema if f.name != column])
    for value in values:
        overwrite_path(none, f"{location.rstrip('/')}/{column}={value}")
    if values:
        _add_partitions(spark, name, [column], list(values))


def _for_table(df: DataFrame, name: str) -> tuple[DataFrame, list[str], str]:
    """``df`` with the table's columns, the table's partition columns, and its location."""
    spark = df.sparkSession
    part_cols = [c.name for c in spark.catalog.listColumns(name) if getattr(c, "isPartition", False)]
    target = spark.table(name).schema
    missing = [c for c in target.names if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} of table {name!r} are missing from the data")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_quote(name)}").filter("col_name = 'Location'")
    location = described.first()["data_type"]
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in target)), part_cols, location


def _refresh(spark: SparkSession, name: str, partitions: str | None) -> None:
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {_quote(name)} {partitions} PARTITIONS")
    spark.sql(f"REFRESH TABLE {_quote(name)}")


def publish_table(df: DataFrame, name: str, root: str) -> str:
    """Write ``df`` as a new version folder, then point table ``name`` at it.

    Readers see the old version until the new one is complete: the data is
    written first to ``root/name/version=<id>`` and only then does one
    catalog update switch the table's location. A failed write leaves the
    published table untouched (unlike purge-then-write). Old versions are
    kept for retention tooling to expire. Returns the new location.
    When the columns or their types change, the catalog entry is re-created
    instead (drop, then create at the new location), so the table's schema
    is always that of its data.
    """
    spark = df.sparkSession
    location = f"{root.rstrip('/')}/{name.replace('.', '/')}/version={uuid.uuid4().hex}"
    overwrite_path(df, location)
    _ensure_database(spark, name, root)
    schema = spark.read.parquet(location).schema
    if spark.catalog.tableExists(name) and _same_columns(spark.table(name).schema, schema):
        spark.sql(f"ALTER TABLE {_quote(name)} SET LOCATION {_text(location)}")
        spark.sql(f"REFRESH TABLE {_quote(name)}")
    else:
        # New table, or new columns / types: the catalog entry is re-created
        # (the table is external, so dropping the entry deletes no data).
        spark.sql(f"DROP TABLE IF EXISTS {_quote(name)}")
        spark.sql(f"CREATE TABLE {_quote(name)} ({ddl(schema)}) USING parquet LOCATION {_text(location)}")
    return location


def _same_columns(a: StructType, b: StructType) -> bool:
    return [(f.name, f.dataType) for f in a.fields] == [(f.name, f.dataType) for f in b.fields]


def passthrough_view(spark: SparkSession, view: str, source: str, temporary: bool = True) -> DataFrame:
    """``CREATE OR REPLACE [TEMP] VIEW view AS SELECT * FROM source``."""
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    if not temporary:
        _ensure_database(spark, view)
    spark.sql(f"CREATE OR REPLACE {kind} {_quote(view)} AS SELECT * FROM {_quote(source)}")
    return spark.table(view)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a DataFrame under a session view name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def preview(df: DataFrame, n: int = 10, order_by: list | None = None) -> DataFrame:
    """The first ``n`` rows, in ``order_by`` order when given (a top-k).

    Returned as a DataFrame so it can be tested or shown on demand; nothing
    runs until an action is called.
    """
    if order_by:
        cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
        return df.orderBy(*cols).limit(n)
    return df.limit(n)
