"""Session helpers: shared scratch location and suggested scale settings."""

from countlens.session import ensure_checkpoint_dir, scale_conf, scratch_path


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    got = ensure_checkpoint_dir(spark)
    assert configured.rstrip("/").split("/")[-1] in got  # a sub-folder of the configured one
    assert ensure_checkpoint_dir(spark) == got  # stable


def test_scratch_paths_are_fresh_and_shared(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    root = ensure_checkpoint_dir(spark)
    assert a != b and a.startswith(root) and b.startswith(root)


def test_scale_conf():
    conf = scale_conf(4000)
    assert conf["spark.sql.shuffle.partitions"] == "12000"
    assert conf["spark.sql.adaptive.autoBroadcastJoinThreshold"] == "64m"
