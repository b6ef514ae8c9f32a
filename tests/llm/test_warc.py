import base64
import hashlib
from collections import Counter

from pyspark.sql import functions as F

from countlens.llm import queries, warc
from tests.llm import helpers as hp


def brute(rows, min_bytes=0):
    data = [(i, (t or "").encode()) for i, t in rows]
    top = {}
    for i, b in data:
        if len(b) >= min_bytes:
            top.setdefault(b, []).append(-1 if i is None else i)
    out = Counter()
    for i, b in data:
        best = max(top.get(b, [-1]))
        revisit = b in top and best >= 0 and i != best
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out[i, len(b), digest, "revisit" if revisit else "response", best if revisit else None] += 1
    return out


def test_query_matches_brute_force(spark):
    rows = [(r["page_id"], r["html"]) for r in hp.rows_of(hp.SF, "pages")]
    assert Counter(tuple(r) for r in queries.op4_warc(spark, hp.SF).collect()) == brute(rows)


def odd_pages(spark):
    big = "<p>grüße</p>\r\n\r\nWARC/1.0\r\n" * 9000
    htmls = ["<p>a</p>", None, "", big, "<p>a</p>", big, "\x00\x01é\n\n", "<p>a</p>"]
    rows = [(i, f"http://x/{i}" if i % 3 else None, h) for i, h in enumerate(htmls)]
    rows += [(7, "http://x/again", "<p>a</p>"), (None, "http://x/null", "<p>a</p>"), (None, None, "only null"), (9, "http://x/\r\nA: b", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in ("digest", "payload", "file", "offset", "length", "region", "top", "n", "id"):
        df = df.withColumn(c, F.lit("clash"))
    return rows, df


def test_round_trip_of_odd_pages(spark, monkeypatch):
    """Payloads, URLs and types come back from ranges in many small files."""
    rows, df = odd_pages(spark)
    index = warc.write_archives(df.repartition(3))
    got = warc.read_records(index).collect()
    want = brute([(i, h) for i, _, h in rows])
    found = Counter(
        (int(r["page_id"]) if r["page_id"] else None, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"] and int(r["refers_to"]))
        for r in got
    )
    assert found == want
    texts = Counter((r["page_id"], r["payload"]) for r in got if r["record_type"] == "response")
    assert ("5", rows[5][2]) in texts and ("9", "z") in texts
    assert {r["url"] for r in got if r["page_id"] == "9"} == {"http://x/%0D%0AA: b"}


def test_selected_records_only(spark):
    _, df = odd_pages(spark)
    index = warc.write_archives(df.repartition(1))
    got = warc.read_records(index.filter("page_id in ('3', '6')")).collect()
    assert {r["page_id"] for r in got} == {"3", "6"}
    assert warc.read_records(index.filter("false")).count() == 0


def test_small_payloads_are_all_responses(spark):
    rows, df = odd_pages(spark)
    got = warc.read_records(warc.write_archives(df, min_bytes=100), payload=False).collect()
    types = Counter((r["page_id"] and int(r["page_id"]), r["record_type"]) for r in got)
    assert types[0, "response"] == 1 and types[3, "revisit"] == 1 and types[5, "response"] == 1


def test_no_pages(spark):
    index = warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.read_records(index).count() == 0


def test_files_are_standard_gzip_members(spark):
    """The whole file decompresses to records one after another."""
    import gzip

    _, df = odd_pages(spark)
    index = warc.write_archives(df.repartition(1)).collect()
    store, path = warc.file_system(index[0]["file"])
    with store.open_input_file(path) as f:
        raw = gzip.decompress(f.read())
    assert raw.startswith(b"WARC/1.0\r\n") and raw.endswith(b"\r\n\r\n")
    assert raw.count(b"WARC-Record-ID") == sum(r["page_id"] is not None for r in index)
