import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from countlens.llm import langid, queries
from tests.llm import helpers as hp


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op2_langid(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = out.filter("held_out and lang is not null").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98


def test_predictions_need_the_text_only(spark):
    docs = hp.odd_docs(spark, extra=False)
    model = langid.learn(docs.filter(~langid.held_out()))
    a = langid.predict(docs, model).select("doc_id", "lang_pred", "score")
    b = langid.predict(docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("q")), model)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select("doc_id", "lang_pred", "score").collect()))


def test_odd_rows(spark):
    docs = hp.odd_docs(spark)
    out = langid.predict(docs, langid.learn(docs)).collect()
    assert len(out) == docs.count()
    by_id = {r["doc_id"]: r for r in out}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (0, 1, 2, 7))
    assert by_id[6]["lang_pred"] in ("en", "fr") and all(0 <= r["score"] <= 1 for r in out)
    assert by_id[None]["held_out"] is False
    nothing = langid.predict(docs, langid.learn(docs.filter("false"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"} and {r["score"] for r in nothing} == {0.0}
    assert langid.predict(hp.empty_docs(spark), langid.learn(docs)).count() == 0


def test_sums_match_plain_naive_bayes(spark):
    """Posterior of a few texts, n-gram by n-gram."""
    rows = [(0, "the cat sat", "en"), (1, "der hund lief", "de"), (2, "the dog", "en"), (3, None, "de"), (4, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, logs, prior = langid.learn(docs, sizes=(2,), bits=16)
    assert langs == ["de", "en"] and np.allclose(np.exp(prior), [0.5, 0.5])
    import pyarrow as pa

    points, at = langid.code_points(pa.array(["the hund"]))
    ((h, _),) = langid.ngrams(points, at, (2,), 16)
    total = prior + logs[h].astype(float).sum(axis=0)
    got = langid.predict(spark.createDataFrame([(9, "the hund")], "doc_id long, text string"), (langs, logs, prior), sizes=(2,))
    r = got.first()
    odds = np.exp(total - total.max())
    assert r["lang_pred"] == langs[int(total.argmax())] and abs(r["score"] - odds.max() / odds.sum()) < 1e-6


def test_ngrams_stay_within_rows():
    import pyarrow as pa

    points, at = langid.code_points(pa.array(["ab", None, "a", "ÄBC", "😀é"]))
    assert at.tolist() == [0, 2, 2, 3, 6, 8]
    (two, at2), (three, at3) = langid.ngrams(points, at, (2, 3), 16)
    assert np.diff(at2).tolist() == [1, 0, 0, 2, 1] and np.diff(at3).tolist() == [0, 0, 0, 1, 0]
    alone = [next(langid.ngrams(*langid.code_points(pa.array([t])), (2,), 16))[0].tolist() for t in ("ab", "äbc", "😀é")]
    assert two.tolist() == sum(alone, [])


def buckets(text):
    """Hashed 2- and 3-grams of one text, in plain Python."""
    low = [ord(c.lower()) if ord(c) < 0x10000 and len(c.lower()) == 1 else ord(c) for c in text or ""]
    for n in (2, 3):
        for i in range(len(low) - n + 1):
            h = n
            for x in low[i : i + n]:
                h = (h * 0x9E3779B97F4A7C15 + x) % 2**64
            yield h * 0xD6E8FEB86659FD93 % 2**64 >> 48


def test_query_equals_plain_naive_bayes(spark):
    """The whole query against multinomial naive Bayes on counters."""
    docs = hp.rows_of(hp.SF, "documents")
    held = lambda d: zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0
    grams, number = defaultdict(Counter), Counter()
    for d in docs:
        if not held(d) and d["lang"] is not None:
            grams[d["lang"]].update(buckets(d["text"]))
            number[d["lang"]] += 1
    langs = sorted(grams)
    logs = {}
    for lang in langs:
        all_grams = sum(grams[lang].values()) + 0.5 * 2**16
        logs[lang] = [float(np.float32(math.log((grams[lang][b] + 0.5) / all_grams))) for b in range(2**16)]
    got = {r.doc_id: r for r in queries.op2_langid(spark, hp.SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        own = Counter(buckets(d["text"]))
        total = {x: math.log(number[x] / sum(number.values())) + sum(n * logs[x][b] for b, n in own.items()) for x in langs}
        best = max(langs, key=lambda x: total[x])  # the first of equals
        r = got[d["doc_id"]]
        assert r.held_out == held(d)
        if any(c.isalpha() for c in d["text"] or ""):
            assert r.lang_pred == best
            assert abs(r.score - 1 / sum(math.exp(total[x] - total[best]) for x in langs)) < 1e-6
        else:
            assert r.lang_pred == "und"


def test_ties_go_to_the_first_language(spark):
    docs = spark.createDataFrame([(1, "abab", "zz"), (2, "abab", "aa")], "doc_id long, text string, lang string")
    got = langid.predict(docs, langid.learn(docs)).collect()
    assert {r["lang_pred"] for r in got} == {"aa"} and all(abs(r["score"] - 0.5) < 1e-9 for r in got)


def test_small_blocks_and_many_languages_change_nothing(spark):
    """However few n-grams are looked up at once; 400 languages, and texts longer than a block."""
    rows = [(i, f"word{i} " * (3 + i % 50), f"l{i:03}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(docs)
    assert len(model[0]) == 400
    want = sorted(map(tuple, langid.predict(docs, model).select("doc_id", "lang_pred").collect()))
    assert sum(lang == f"l{i:03}" for i, lang in want) > 300
    got = sorted(map(tuple, langid.predict(docs, model, cells=400 * 60).select("doc_id", "lang_pred").collect()))
    assert got == want
