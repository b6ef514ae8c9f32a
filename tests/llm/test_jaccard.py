import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from countlens.llm import jaccard
from tests.llm import helpers as hp


def shingle_set(text):
    w = hp.spaced_words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(ids, texts):
    sets = [shingle_set(t) for t in texts]
    classes = hp.Union(len(sets))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)) and 100 * len(a & b) >= 75 * len(a | b):
                classes.join(i, j)
    return Counter(zip(ids, map(len, sets), classes.least(ids), strict=True))


def got(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def test_matches_brute_force_on_the_table(spark):
    rows = hp.rows_of(hp.SF, "documents")
    df = spark.read.parquet(f"{hp.SF}/documents.parquet")
    assert got(jaccard.classes(df)) == brute([r["doc_id"] for r in rows], [r["text"] for r in rows])


def test_odd_rows_and_clashing_columns(spark):
    df = hp.odd_docs(spark)
    rows = df.select("doc_id", "text").collect()
    assert got(jaccard.classes(df)) == brute([r[0] for r in rows], [r[1] for r in rows])
    assert jaccard.classes(hp.empty_docs(spark)).count() == 0


def test_near_copies_around_the_threshold_and_a_common_passage(spark):
    """Chains of edits, a group around one text, and unrelated texts that share half their words."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    texts = []
    for size in (7, 12, 30, 90, 400):
        base = [word() for _ in range(size)]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, size // 28))):
                copy[rng.randrange(size)] = word()
            texts.append(" ".join(copy))
            if rng.random() < 0.3:
                base = copy
    passage = [word() for _ in range(60)]
    texts += [" ".join([word() for _ in range(rng.randint(20, 60))] + passage) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute(range(len(texts)), texts)
    assert sum(1 for (i, _, c) in want if i != c) > 20
    assert got(jaccard.classes(df)) == want


def test_blocks_of_a_large_group_find_the_same_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rng = random.Random(3)
    base = [str(rng.random()) for _ in range(40)]
    texts = []
    for i in range(24):  # neighbours on a line are near, others are not
        base = list(base)
        base[i % 40] = f"w{i}"
        texts.append(" ".join(base))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert got(jaccard.classes(df)) == brute(range(len(texts)), texts)


def test_sketch_distance_is_a_lower_bound_and_folds():
    rng = np.random.default_rng(0)
    for n in (5, 80, 700, 3000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64))
        b = np.unique(np.concatenate([a[: n - n // 5], rng.integers(0, 1 << 63, n // 4, dtype=np.int64).astype(np.uint64)]))
        apart = len(np.setxor1d(a, b))
        x, y = jaccard.sketch(a), jaccard.sketch(b)
        words = min(len(x), len(y))
        assert np.bitwise_count(jaccard.fold(x, words) ^ jaccard.fold(y, words)).sum() <= apart


def test_linking_sets_share_many_keys():
    """At the threshold, sets of any size agree in several join keys."""
    rng = np.random.default_rng(1)
    least = []
    for n in (40, 63, 64, 100, 250, 1000, 5000):
        for _ in range(20):
            members = rng.integers(0, 1 << 62, 2 * n, dtype=np.int64).astype(np.uint64) * np.uint64(4)
            common = -(-6 * n // 7)
            a, b = np.unique(members[:n]), np.unique(np.concatenate([members[:common], members[n : 2 * n - common]]))
            least.append(len(np.intersect1d(jaccard.keys_of(a), jaccard.keys_of(b))))
    assert min(least) >= 5


def test_one_row_per_row(spark):
    df = hp.odd_docs(spark)
    out = jaccard.classes(df)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert out.count() == df.count()
    assert out.filter(F.col("n_shingles") == 0).filter("component_id <> doc_id").count() == 0


def test_common_passages_make_no_large_groups_of_unlike_texts(spark):
    """A passage in all of many unlike texts leaves few of them to compare, and loses no link."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = [word() for _ in range(16)]  # 12 shingles
    texts = [" ".join([word() for _ in range(rng.randint(25, 45))] + passage) for _ in range(600)]
    for t in texts[:40]:  # a near copy each, on the passage's side or the other
        w = t.split(" ")
        w[0 if rng.random() < 0.5 else -1] = word()
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute(range(len(texts)), texts)
    assert sum(1 for i, _, c in want if i != c) == 40 and got(jaccard.classes(df)) == want

    nodes = jaccard._profiles(df.select(F.col("doc_id").alias("doc"), "text"))
    every = nodes.select(F.explode("keys").alias("key")).groupBy("key").count().agg(F.max("count")).first()[0]
    small = nodes.filter("n < 64")
    kept = jaccard._shared_keys(small).groupBy("key").count().agg(F.max("count")).first()[0]
    assert every >= 600 and kept <= 60


def test_commonest_keys_left_out_keep_one_of_each_linking_pair():
    """Whatever keys are common: small sets exactly, larger ones while they share more than SPARED."""
    rng = np.random.default_rng(8)
    for n in (1, 2, 3, 4, 7, 8, 20, 47, 63):
        for _ in range(60):
            pool = rng.permutation(4 * n + 8).astype(np.uint64) + np.uint64(1)
            m = min(63, n + int(rng.integers(0, n // 3 + 1)))
            common = -(-3 * (n + m) // 7)
            if common > n:
                continue
            a, b = pool[:n], np.concatenate([pool[:common], pool[n : n + m - common]])
            order = rng.permutation(len(pool) + 2)  # any order of rarity
            kept = [set(sorted(s.tolist(), key=lambda k: order[k])[: len(s) // 4 + 1]) for s in (a, b)]
            assert kept[0] & kept[1]
