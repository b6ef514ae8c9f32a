"""A sensor holding a third of all rows, all on one day: results must equal a
brute force, and every aggregation must pre-aggregate before its shuffle."""

import random
from collections import defaultdict

import pytest

from countlens.operators import checks as ck
from countlens.plans.reports import decline_report, top_n_by_day
from tests.helpers import plan_text


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        if i % 3 == 0:  # the hot sensor: a third of the rows, one day
            rows.append((i, f"2019-06-01T{i % 24:02d}:00:00", 1, rnd.randint(0, 9)))
        else:
            day = rnd.choice(["2019-06-01", "2019-06-02", "2022-06-01", "2022-06-02"])
            rows.append((i, f"{day}T{rnd.randint(0, 23):02d}:00:00", rnd.randint(2, 60), rnd.randint(0, 9)))
    df = spark.createDataFrame(rows, "id int, date_time string, sensor_id int, hourly_count int")
    dim = spark.createDataFrame([(k, f"S{k}") for k in range(1, 61)], "location_id int, sensor_description string")
    return rows, df.repartition(8), dim


def test_top_n_under_skew(skewed):
    rows, df, dim = skewed
    got = sorted((r.date, r.rank, r.sensor_id, r.daily_count) for r in top_n_by_day(df, dim, n=5).collect())
    totals = defaultdict(int)
    for _, ts, k, v in rows:
        totals[(ts[:10], k)] += v
    want = []
    for day in sorted({d for d, _ in totals}):
        ranked = sorted(((-t, k) for (d, k), t in totals.items() if d == day))[:5]
        want += [(day, i + 1, k, -t) for i, (t, k) in enumerate(ranked)]
    assert got == sorted(want)


def test_change_under_skew(skewed):
    rows, df, dim = skewed
    rep = decline_report(df, dim, ("2019-01-01", "2020-01-01"), ("2022-01-01", "2023-01-01"))
    got = {r.sensor_id: (r.count_2019, r.count_2022) for r in rep.collect()}
    a, b = defaultdict(int), defaultdict(int)
    for _, ts, k, v in rows:
        (a if ts < "2020" else b)[k] += v
    assert got == {k: (a[k], b[k]) for k in a.keys() & b.keys()}
    assert "partial_sum" in plan_text(rep)


def test_unique_under_skew(skewed, spark):
    rows, df, _ = skewed
    res = ck.run_checks(df, [ck.unique("sensor_id")]).first()
    counts = defaultdict(int)
    for _, _, k, _ in rows:
        counts[k] += 1
    assert res.failures == sum(1 for c in counts.values() if c > 1)
    assert "partial_count" in plan_text(ck.run_checks(df, [ck.unique("sensor_id")]))


def test_hot_month_of_day_totals_is_split_on_write(spark):
    """Day totals of a batch whose one month holds most rows: the totals
    equal a brute force, and the hot month is written by several tasks (the
    rebalance lets AQE split it) rather than by one."""
    import os

    from countlens.plans import jobs
    from countlens.session import scratch_path

    rnd = random.Random(11)
    rows = []
    for i in range(6000):
        if i % 3:  # two thirds of the rows in June 2019
            ts = f"2019-06-{rnd.randint(1, 30):02d}T{rnd.randint(0, 23):02d}:00:00"
        else:
            ts = f"20{rnd.randint(10, 22)}-0{rnd.randint(1, 5)}-1{rnd.randint(0, 9)}T05:00:00"
        rows.append((i, ts, rnd.randint(1, 200), "s", rnd.randint(0, 50), ts[:7]))
    batch = spark.createDataFrame(
        rows, "id int, date_time string, sensor_id int, sensor_name string, "
        "hourly_count int, year_month string",
    ).repartition(8)
    # A tiny target size so the test data counts as large, and no coalescing
    # of the aggregate stage: on real input it has many tasks, and AQE splits
    # a hot rebalance partition along those tasks' outputs.
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "4k")
    spark.conf.set(keys[1], "false")
    try:
        location = scratch_path(spark, "hot-month")
        name = jobs.refresh_day_totals(spark, batch, location, "skew_db")
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
    want = defaultdict(lambda: [0, 0])
    for _, ts, k, _, v, _ in rows:
        want[(ts[:10], k)][0] += v
        want[(ts[:10], k)][1] += 1
    got = {(str(r.day), r.sensor_id): [r.total, r.n_rows] for r in spark.table(name).collect()}
    assert got == dict(want)
    folder = location[len("file:"):] if location.startswith("file:") else location
    hot = [f for f in os.listdir(os.path.join(folder, "year_month=2019-06")) if f.endswith(".parquet")]
    assert len(hot) > 1
