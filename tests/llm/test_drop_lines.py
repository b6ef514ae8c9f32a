"""Dropping lines: long texts, clashing columns, odd rows."""

import time

from pyspark.sql import functions as F

from countlens.llm.lines import drop_lines
from tests.llm.helpers import CLASHES


def test_many_lines_of_one_document_cost_no_square(spark):
    n = 200_000
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.concat(F.lit("line "), i.cast("string"))), "\n")
    docs = spark.range(1).select(F.col("id").alias("doc_id"), text.alias("text"))
    gone = spark.range(0, n, 2).select(F.lit(0).cast("long").alias("doc_id"), F.col("id").alias("line"))
    start = time.perf_counter()
    (row,) = drop_lines(docs, gone).collect()
    assert time.perf_counter() - start < 30
    assert row.text.split("\n") == [f"line {i}" for i in range(1, n, 2)]


def test_odd_rows_and_clashing_columns(spark):
    rows = [(1, "a\nb\nc"), (2, "a\n\nb\n"), (3, "all"), (4, None), (5, ""), (None, "a\nb"), (6, "kept\nwhole"), (1, "x\ny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for c in CLASHES:
        docs = docs.withColumn(c, F.lit("clash"))
    gone = spark.createDataFrame([(1, 1), (1, 1), (2, 3), (2, 0), (3, 0), (5, 0), (None, 0), (9, 0)], "doc_id long, line long")
    got = drop_lines(docs, gone)
    assert got.columns == docs.columns
    want = [(1, "a\nc"), (2, "\nb"), (3, None), (4, None), (5, None), (None, "a\nb"), (6, "kept\nwhole"), (1, "x")]
    assert sorted(map(tuple, got.select("doc_id", "text").collect()), key=str) == sorted(want, key=str)
