import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from countlens.llm import contamination, queries
from tests.llm import helpers as hp

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").encode().lower())


def brute(docs, items, size=13):
    windows = {}
    for i, t in items:
        w = words(t)
        for s in range(max(len(w) - size + 1, min(1, len(w)))):
            if i is not None:
                windows.setdefault(tuple(w[s : s + size]), set()).add(i)
    out = Counter()
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[tuple(w[s : s + n])]
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out[d, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)] += 1
    return out


def got(df):
    return Counter(tuple(r) for r in df.collect())


def test_query_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in hp.rows_of(hp.SF, "documents")]
    items = [(r["item_id"], r["text"]) for r in hp.rows_of(hp.SF, "benchmark")]
    assert got(queries.op5_contamination(spark, hp.SF)) == brute(docs, items)


def odd(spark):
    docs = hp.odd_docs(spark)
    long = hp.odd_texts()[8].split(" ")
    items = [(1, " ".join(long[500:530])), (2, "one, TWO three"), (10, "one"), (3, None), (4, "--"), (5, " ".join(long[20:33]))]
    items += [(6, " ".join(long[500:530])), (None, "one"), (7, " ".join(long[-6:] + ["tail"])), (7, "é"), (8, "one é")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    return docs, bench, rows, items


def test_odd_rows_small_segments_and_blocks(spark, monkeypatch):
    docs, bench, rows, items = odd(spark)
    for c in ("item", "names", "hits"):
        bench = bench.withColumn(c, F.lit("clash"))
    index = contamination.build_index(docs, segment=1000)
    want = brute(rows, items)
    assert got(queries.contaminated(contamination.search(index, bench))) == want
    monkeypatch.setattr(contamination, "BLOCK_BYTES", 1300)  # of windows: some eight blocks
    assert got(queries.contaminated(contamination.search(index, bench))) == want


def test_empty_tables(spark):
    docs, bench, rows, _ = odd(spark)
    index = contamination.build_index(docs)
    assert got(queries.contaminated(contamination.search(index, bench.filter("false")))) == brute(rows, [])
    nothing = contamination.build_index(hp.empty_docs(spark))
    assert contamination.search(nothing, bench).count() == 0


def test_hits_are_merged_word_ranges(spark):
    docs = spark.createDataFrame([(1, "a b c d e f a b x"), (2, "b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d"), (2, "e f")], "item_id long, text string")
    found = {r["doc_id"]: r for r in contamination.search(contamination.build_index(docs), items, size=2).collect()}
    assert [tuple(x) for x in found[1]["hits"]] == [(0, 8)] and found[1]["items"] == [1, 2]
    assert [tuple(x) for x in found[2]["hits"]] == [(0, 2)] and found[2]["items"] == [1]


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red x x blue"), (2, "blue red"), (3, "red x x x x blue"), (4, "red"), (5, "blue")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "red blue")], "item_id long, text string")
    index = contamination.build_index(docs)
    near = contamination.search(index, items, span=3).filter("size(items) > 0")
    assert sorted(r["doc_id"] for r in near.collect()) == [1, 2]
    exact = contamination.search(index, items).filter("size(items) > 0")
    assert exact.count() == 0


def test_blocks_bound_the_windows_and_split_texts_of_one_id(spark, monkeypatch):
    """One id has a thousand texts: its windows, as broadcast, stay near the bound a block."""
    rows = [(1 if i % 3 else i, " ".join(f"w{i}x{k}" for k in range(40))) for i in range(900)] + [(1, "w1x0 w1x1")] * 50
    bench = spark.createDataFrame(rows, "item_id long, text string")
    monkeypatch.setattr(contamination, "BLOCK_BYTES", 1 << 19)
    blocks = contamination._blocks(bench, "item_id", "text", 13)
    assert len(blocks) > 5
    sizes = []
    for block in blocks:
        texts = [r["text"] for r in block.collect()]
        flat, _, of = contamination.windows(texts, 13)
        sizes.append(flat.nbytes)
    assert max(sizes) < 1.5 * (1 << 19) and sum(b.count() for b in blocks) == 901
