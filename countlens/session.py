"""Session construction and the shared scratch location.

On a cluster the session comes from the platform and ``spark.checkpoint.dir``
names a shared folder (HDFS / object store). Library code only *reads* that
setting; a local fallback is created only when it is unset and the master is
local (tests, laptops).
"""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every countlens job relies on. AQE re-plans shuffles from real
# sizes (coalesces small partitions, splits skewed ones, and turns a
# sort-merge join into a broadcast only when the measured side is small).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def scale_conf(total_cores: int) -> dict[str, str]:
    """Suggested settings for a large cluster (pass as ``extra_conf``).

    Shuffles start at 3x the cores and AQE merges them to ~256 MiB each, so
    partitions fit executor memory whatever the input size; scans split at
    256 MiB; a shuffle partition 5x the median (and > 512 MiB) counts as
    skewed and is split; a join side is broadcast at runtime only when its
    *measured* shuffle output is below 64 MiB.
    """
    return {
        "spark.sql.shuffle.partitions": str(3 * total_cores),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    }


def build_session(
    master: str | None = None,
    app_name: str = "countlens",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the countlens defaults.

    ``shuffle_partitions`` is the *initial* post-shuffle partition count; AQE
    coalesces it down to ``spark.sql.adaptive.advisoryPartitionSizeInBytes``
    sized partitions, so on a cluster set it high (e.g. 4x total cores).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


@functools.cache
def _connect_scratch() -> str:
    """One local folder per process, for Spark Connect to a local master."""
    return tempfile.mkdtemp(prefix="countlens-ckpt-")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    The folder named by ``spark.checkpoint.dir`` (or an earlier
    ``setCheckpointDir``) wins. Without one, a local master gets a fresh temp
    folder; a cluster master raises, because a machine-local folder is not
    visible to other executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context, only conf
        sc = None
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            return configured
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        return _connect_scratch()
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(e.g. an HDFS or object-store path) visible to every executor"
        )
    local = tempfile.mkdtemp(prefix="countlens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint location.

    Used for written intermediate tables (lineage cuts, round trips). Each
    call gets a new unique sub-folder, so concurrent or retried jobs never
    collide and nothing has to be deleted first.
    """
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "countlens", f"{name}-{uuid.uuid4().hex}")
