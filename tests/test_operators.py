"""Direct tests of the label join, the ranking cut and the view sink."""

from countlens.operators.enrich import with_label
from countlens.operators.ranking import rank_within, within_reach
from countlens.sources.tables import publish_view


def test_label_join_keeps_misses_and_shows_duplicate_keys(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, v int")
    dim = spark.createDataFrame([(1, "one"), (2, "two"), (2, "deux")], "id int, name string")
    rows = sorted((tuple(r) for r in with_label(facts, dim, "k", "id", "name", "label").collect()), key=str)
    # a missing key keeps a NULL label; a duplicated key multiplies the fact
    assert rows == [(1, 10, "one"), (2, 20, "deux"), (2, 20, "two"), (3, 30, None)]


def test_rank_within_breaks_ties_by_id(spark):
    totals = spark.createDataFrame(
        [("d1", 3, 5), ("d1", 1, 5), ("d1", 2, 9), ("d1", None, 5), ("d2", 7, None), ("d2", 8, 1)],
        "p string, k int, t int",
    )
    got = sorted((tuple(r) for r in rank_within(totals, "p", "k", "t", 3).collect()), key=str)
    # value descending (NULL last), then id ascending (NULL first)
    want = [("d1", 2, 9, 1), ("d1", None, 5, 2), ("d1", 1, 5, 3),
            ("d2", 8, 1, 1), ("d2", 7, None, 2)]
    assert got == sorted(want, key=str)


def test_publish_view(spark):
    v = publish_view(spark.createDataFrame([(1,), (2,)], "x int"), "published_v")
    assert v.count() == 2
    assert spark.sql("SELECT sum(x) AS s FROM published_v").first().s == 3


def test_within_reach_keeps_all_that_is_ranked(spark):
    """Ties, null values and ids, a null period, and periods of few rows or few values rank as without it."""
    rows = [(p, k, (k * 7919) % 23 if k % 11 else None) for p in ("d1", None) for k in range(400)]
    rows += [("few", k, k) for k in range(3)] + [("none", k, None) for k in range(50)] + [("tied", k, 1) for k in range(50)]
    totals = spark.createDataFrame([*rows, ("d1", None, 22), ("d1", 5000, 22)], "p string, k int, t int")
    for n in (1, 5, 101):
        near = within_reach(totals, "p", "k", "t", n)
        want = sorted(map(tuple, rank_within(totals, "p", "k", "t", n).collect()), key=str)
        assert sorted(map(tuple, rank_within(near, "p", "k", "t", n).collect()), key=str) == want
    near = within_reach(totals, "p", "k", "t", 5)
    assert near.columns == totals.columns and near.filter("p = 'd1'").count() < 150
    assert near.filter("p = 'none'").count() == 50
