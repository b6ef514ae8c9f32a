"""The licence scan: base phrases against a search in Python, matches on planted texts, SQL functions only."""

import random
import re

import duckdb
from pyspark.sql import functions as F

from countlens.llm import licenses, oracles
from countlens.llm.queries import op11_licenses
from tests.helpers import plan_text
from tests.llm.helpers import DOCS, SF, empty_docs, odd_docs, rows_of

WORD = re.compile(licenses.WORD)
FOLD = str.maketrans(licenses.UPPER, licenses.LOWER)


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def base(text):
    ws, out = words(text), []
    for i in range(len(ws)):
        out += [(label, i) for label, p in licenses.BASE_PHRASES if ws[i : i + len(p.split())] == p.split()]
    return sorted(out, key=lambda x: x[1])


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)


def filler(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "any", "this", "with", "lorem", "ipsum", "dolor", "is"]) for _ in range(n))


def test_query_equals_brute_force_and_sql(spark):
    got = {r.doc_id: r for r in op11_licenses(spark, SF).collect()}
    for d in rows_of(SF, "documents"):
        r, found = got[d["doc_id"]], base(d["text"])
        starts = [i for _, i in found]
        assert (r.n_words, r.n_base) == (len(words(d["text"])), len(found))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if found else (None, None))
        assert r.base_labels == ",".join(sorted({x for x, _ in found}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    sql = oracles.licenses_sql(licenses.TEMPLATES, licenses.BASE_PHRASES, licenses.RARE, licenses.BAND, licenses.MIN_SCORE)
    want = {r[0]: r for r in con.execute(sql).fetchall()}
    assert {i: tuple(r) for i, r in got.items()} == want


def test_whole_and_edited_notices_are_found_and_plain_text_is_not(spark):
    rng = random.Random(1)
    texts, want = [], []
    for label, text, keys in licenses.TEMPLATES:
        texts.append(f"{filler(rng, 80)}.\n{text}\n{filler(rng, 300)}")
        want.append(label)
    long = licenses.TEMPLATES[1][1]
    edited = long.replace("associated documentation files", "docs").replace("copyright notice and", "notice and")
    texts += [filler(rng, 50) + " " + edited, long[:60], filler(rng, 4000), "permission granted", " ".join(reversed(long.split()))]
    want += ["mit", None, None, None, None]
    found = licenses.scan(docs(spark, texts)).orderBy("doc_id").collect()
    for row, label, text in zip(found, want, texts, strict=True):
        labels = {m.label for m in row.matches}
        assert (label in labels) if label else not labels, text
    start = found[1].matches[0].start
    assert found[1].matches[0].score == 1.0 and start == 80


def test_key_phrases_are_mandatory(spark):
    gpl = licenses.TEMPLATES[7][1]
    found = licenses.scan(docs(spark, [gpl, gpl.replace("version 3 of", "release three of")])).orderBy("doc_id").collect()
    assert "gpl-3" in {m.label for m in found[0].matches} and "gpl-3" not in {m.label for m in found[1].matches}


def test_base_phrases_across_punctuation_and_places(spark):
    texts = ["UNDER THE (MIT) LICENSE under-the mit license.", "Apache License, Version 2.0; cc BY-NC", "under the mit licenses", "cc byé nc"]
    found = licenses.scan(docs(spark, texts)).orderBy("doc_id").collect()
    assert [[tuple(x) for x in r.base] for r in found] == [base(t) for t in texts]
    assert [len(r.base) for r in found] == [2, 2, 0, 0]


def test_odd_and_empty_tables(spark):
    df = odd_docs(spark)
    found = licenses.scan(df)
    want = sorted(((r.doc_id, len(words(r.text))) for r in df.collect()), key=str)
    assert sorted(((r.doc_id, r.n_words) for r in found.collect()), key=str) == want
    assert licenses.scan(empty_docs(spark)).count() == 0


def test_main_path_runs_sql_functions_only(spark):
    found = licenses.scan(docs(spark, ["Released under the MIT License."]))
    plan = plan_text(found) + plan_text(licenses.template_words(spark))
    assert not re.search("Python|Arrow|ExistingRDD|BroadcastNestedLoop|CartesianProduct", plan)
    assert found.select(F.size("matches")).first()[0] == 1
