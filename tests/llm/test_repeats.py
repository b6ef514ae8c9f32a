import hashlib
from collections import Counter, defaultdict

import pytest

from countlens.llm import queries, repeats
from tests.llm import helpers as hp


def brute(rows, length):
    """(id, bytes, removed, spans, digest) of each row."""
    seen = defaultdict(int)
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        for s in range(len(b) - length + 1):
            seen[b[s : s + length]] += 1
    out = Counter()
    for i, b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def got(found):
    out = Counter()
    for r in found.collect():
        removed = sum(s["end"] - s["start"] for s in r["spans"])
        assert r["kept_sha256"] == hashlib.sha256(bytes(r["kept"])).hexdigest()
        out[r["doc_id"], r["n_bytes"], removed, len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest()] += 1
    return out


def test_query_matches_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in hp.rows_of(hp.SF, "documents")]
    found = queries.op10_repeats(spark, hp.SF)
    assert Counter(tuple(r) for r in found.collect()) == brute(rows, 200)


@pytest.mark.parametrize("many", [8192, 1])
def test_odd_rows(spark, many):
    """Also with every differing anchor gram counted by the plain aggregate."""
    texts = [t for t in hp.odd_texts() if len(t or "") < 50_000]
    df = hp.odd_docs(spark, texts)
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert got(repeats.removed(df, many=many)) == brute(rows, 200)
    assert repeats.removed(hp.empty_docs(spark)).count() == 0


def test_texts_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 700)
    texts = [r["text"] for r in hp.rows_of(hp.SF, "documents")][:40]
    df = spark.createDataFrame(list(enumerate([*texts, texts[3][50:] + texts[5][10:]])), "doc_id long, text string")
    rows = [tuple(r) for r in df.collect()]
    assert got(repeats.removed(df)) == brute(rows, 200)


def test_maximal_repeats_by_definition():
    """Against all pairs of places: maximal to both sides, with all occurrences."""
    contexts = [b"abracadabra!xyz", b"cadabra?xyzabra", b"zabracad"]
    want = defaultdict(set)
    places = [(c, o) for c, t in enumerate(contexts) for o in range(len(t))]
    for c, o in places:
        for d, p in places:
            if (c, o) != (d, p):
                n = 0
                a, b = contexts[c], contexts[d]
                while o + n < len(a) and p + n < len(b) and a[o + n] == b[p + n]:
                    n += 1
                if n >= 3:
                    want[a[o : o + n]] |= {(c, o), (d, p)}
    full = {s: {(c, o) for c, o in places if contexts[c][o : o + len(s)] == s} for s in want}
    left = lambda c, o: contexts[c][o - 1] if o else 256 + c
    want = {s: m for s, m in full.items() if len({left(*x) for x in m}) > 1}
    nodes = repeats.maximal_repeats(contexts, 3)
    members = [set(x.own) for x in nodes]
    for i, x in enumerate(nodes):  # inner ones come first
        if x.parent is not None:
            members[x.parent] |= members[i]
    texts = [contexts[x.example[0]][x.example[1] :][: x.size] for x in nodes]
    assert dict(zip(texts, members, strict=True)) == want and want and len(set(texts)) == len(texts)
    assert sum(len(x.own) for x in nodes) == len({m for x in nodes for m in x.own})
