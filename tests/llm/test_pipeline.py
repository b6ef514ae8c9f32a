"""Each stage of the pipeline on its own input, and the whole."""

import pytest

pipeline = pytest.importorskip("corpus_pipeline")

from pyspark.sql import functions as F  # noqa: E402

from countlens.llm import queries  # noqa: E402
from tests.llm import helpers as hp  # noqa: E402
from tests.llm import test_contamination, test_jaccard, test_lines  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGE = dict(pipeline.STAGES)


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text").collect()), key=str)


def test_stages_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "mixing"]


def test_quality_keeps_what_the_query_scores_high(spark):
    docs = spark.read.parquet(f"{hp.SF}/documents.parquet")
    out = STAGE["quality"](spark, docs, hp.SF)
    keep = {r["doc_id"] for r in queries.op7_quality(spark, hp.SF).filter("predicted = 1").collect()}
    assert out.columns == COLUMNS and rows(out) == [r for r in rows(docs) if r[0] in keep]


def test_line_dedup_by_brute_force(spark):
    docs = spark.read.parquet(f"{hp.SF}/documents.parquet").unionByName(hp.odd_docs(spark, ["a\nb", "", None], extra=False).limit(0))
    out = STAGE["line_dedup"](spark, docs, hp.SF)
    gone = test_lines.brute(rows(docs))
    want = []
    for i, t in rows(docs):
        left = [x for k, x in enumerate(t.split("\n")) if (i, k) not in gone]
        want += [(i, "\n".join(left))] if left else []
    assert out.columns == COLUMNS and rows(out) == sorted(want, key=str)
    assert out.filter(F.length("text") != F.col("n_chars")).count() == 0


def test_one_of_each_class_by_brute_force(spark):
    docs = spark.read.parquet(f"{hp.SF}/documents.parquet")
    out = STAGE["near_duplicates"](spark, docs, hp.SF)
    first = {i for i, _, c in test_jaccard.brute(*zip(*rows(docs), strict=True)) if i == c}
    assert out.columns == COLUMNS and rows(out) == [r for r in rows(docs) if r[0] in first]


def test_decontamination_by_brute_force(spark):
    docs = spark.read.parquet(f"{hp.SF}/documents.parquet")
    out = STAGE["decontamination"](spark, docs, hp.SF)
    items = [(r["item_id"], r["text"]) for r in hp.rows_of(hp.SF, "benchmark")]
    bad = {r[0] for r in test_contamination.brute(rows(docs), items) if r[-1]}
    assert bad and out.columns == COLUMNS and rows(out) == [r for r in rows(docs) if r[0] not in bad]


@pytest.mark.parametrize("name", list(STAGE))
def test_odd_and_empty_tables(spark, name):
    odd = hp.odd_docs(spark)
    out = STAGE[name](spark, odd, hp.SF)
    assert out.count() <= odd.count()
    if name != "mixing":
        assert out.columns == COLUMNS
    assert STAGE[name](spark, hp.empty_docs(spark), hp.SF).count() == 0


def test_line_stage_tells_repeated_and_null_ids_apart(spark):
    hot, own, more = "a hot line of seven words here", "one line of its own text", "some more text of this row"
    data = [(0, hot), (1, f"{own}\n{hot}"), (1, f"{hot}\n{more}"), (1, f"{hot}\n{more}")]
    data += [(None, f"{hot}\nalone"), (None, f"first\n{hot}"), (None, hot), (None, None), (2, None)]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in data], hp.DOCS)
    want = [(0, hot), (1, own), (1, more), (1, more), (None, "alone"), (None, "first"), (None, None), (2, None)]
    assert rows(STAGE["line_dedup"](spark, docs, hp.SF)) == sorted(want, key=str)


def test_near_duplicate_stage_tells_repeated_ids_apart(spark):
    text = " ".join(f"w{i}" for i in range(40))
    data = [(1, text), (1, text), (2, text + " more"), (3, "other"), (3, "else"), (None, text), (None, "alone"), (None, "alone"), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in data], hp.DOCS)
    got = rows(STAGE["near_duplicates"](spark, docs, hp.SF))
    assert got == sorted([(1, text), (3, "other"), (3, "else"), (None, "alone"), (4, None), (5, "")], key=str)


def test_whole_run_is_the_stages_one_after_another(spark):
    out = pipeline.run(spark, hp.SF)
    docs = spark.read.parquet(f"{hp.SF}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, hp.SF)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, docs.collect()))
    assert {"doc_id", "source", "size", "target", "taken"} <= set(out.columns)
