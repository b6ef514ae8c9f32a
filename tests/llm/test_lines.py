from collections import Counter

from pyspark.sql import functions as F

from countlens.llm import lines, queries
from tests.llm import helpers as hp


def near(a, b):
    """Edit distance over words of at most one."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = (a, b) if len(a) < len(b) else (b, a)
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute(rows, min_words=5, near_words=9):
    first = {}
    places = []
    for i, t in rows:
        for k, line in enumerate(t.split("\n") if t is not None else ()):
            w = tuple(hp.spaced_words(line))
            if len(w) >= min_words:
                place = (i is None, -1 if i is None else i, k)
                places.append((w, place, i, k))
                first[w] = min(first.get(w, place), place)
    earlier = {}
    by_length = {}
    for w in first:
        if len(w) >= near_words:
            by_length.setdefault(len(w), []).append(w)
    for w, p in first.items():
        others = [v for n in (len(w) - 1, len(w), len(w) + 1) for v in by_length.get(n, ())] if len(w) >= near_words else ()
        earlier[w] = any(first[v] < p and near(v, w) for v in others)
    return Counter((i, k) for w, p, i, k in places if earlier[w] or p != first[w])


def got(df):
    return Counter((r[0], r["line"]) for r in df.collect())


def test_query_matches_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in hp.rows_of(hp.SF, "documents")]
    found = queries.op8_lines(spark, hp.SF).collect()
    assert Counter((r["doc_id"], k) for r in found for k in r["removed"]) == brute(rows)
    assert all(r["n_removed"] == len(r["removed"]) and r["n_near"] <= r["n_removed"] for r in found)


def test_near_lines_of_every_kind(spark):
    base = [f"word{i}" for i in range(12)]
    other = [f"else{i}" for i in range(9)]
    texts = [
        " ".join(base),
        " ".join(base[:4] + base[5:]) + "\nshort line here",
        " ".join(base[:4] + ["more"] + base[4:]),
        " ".join(["Changed"] + base[1:]).upper(),
        " ".join(base[:-1] + ["changed"]) + "\n" + "  ".join(base),
        " ".join(base[:3] + ["x", "y"] + base[5:]),
        " ".join(base[:-2]),
        " ".join(other) + "\n" + " ".join(other[:-1]) + "\n" + " ".join([*other, "a"]),
        " ".join(["z", *other]) + "\n" + " ".join([*other[1:], "q"]),
        "short line here\na b c d e\na b c d f\nA B C D E",
    ]
    texts += [" ".join([f"same{i}" for i in range(15)] + [f"tail{k}"]) for k in range(40)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(lines.duplicate_lines(df)) == brute(rows)


def test_odd_rows_and_clashing_columns(spark):
    df = hp.odd_docs(spark)
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert got(lines.duplicate_lines(df)) == brute(rows)
    assert lines.duplicate_lines(hp.empty_docs(spark)).count() == 0


def test_dropping_lines(spark):
    texts = ["one two three four five\nkept\n", "one two three four five", "", None, "kept\none two three four  five\nsix"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in lines.drop_lines(df, lines.duplicate_lines(df)).collect()}
    assert out == {0: texts[0], 1: None, 2: "", 3: None, 4: "kept\nsix"}


def test_near_check_on_words():
    assert lines.one_word_apart("A b c", "a  b d") and lines.one_word_apart("a b", "a x b")
    assert not lines.one_word_apart("a b c d", "a b") and not lines.one_word_apart("a b c", "c b a")


def test_place_orders_null_ids_last(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (7, "a b c d e")], "doc_id long, text string")
    assert [r["doc_id"] for r in lines.duplicate_lines(df).filter(F.col("line") == 0).collect()] == [None]


def test_copies_of_long_lines_of_few_words(spark, tmp_path):
    """Text without spaces, a URL and four long words, judged by code points."""
    words = ["a" * 12, "b" * 12, "c" * 12, "d" * 21]
    lines_ = ["東京" * 30, "https://example.org/" + "a" * 40, "  ".join(words), "é" * 59, "All rights reserved.", ""]
    rows = [(1, "\n".join(lines_)), (2, "\n".join(["one", *lines_])), (3, " ".join(words).upper())]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r["removed"] for r in queries.op8_lines(spark, str(tmp_path)).collect()}
    assert found == {2: [1, 2, 3], 3: [0]}


def code_points(line):
    return " ".join(hp.spaced_words(line))


def brute_by_sort(rows, min_words=5, near_words=9, chars=60):
    """As ``brute``, with lines of few words and ``chars`` code points near by one code point."""
    places = [((i is None, -1 if i is None else i, k), i, k, code_points(x)) for i, t in rows if t is not None for k, x in enumerate(t.split("\n"))]
    few = [p for p in places if len(p[3].split(" ")) < near_words and len(p[3]) >= chars]
    near_ones = Counter((i, k) for p, i, k, line in few if any(q < p and near(line, other) for q, _, _, other in few))
    drop = {(place, line) for place, _, _, line in few}
    others = [
        (i, None if t is None else "\n".join("" if ((i is None, -1 if i is None else i, k), code_points(x)) in drop else x for k, x in enumerate(t.split("\n"))))
        for i, t in rows
    ]
    return brute(others, min_words, near_words) + near_ones


def test_near_lines_without_spaces(spark):
    """Text without spaces, URLs, few long words: one code point inserted, deleted or replaced, at every place."""
    plain = "".join(chr(0x4E00 + 7 * i) for i in range(64))
    url = "https://example.org/" + "".join("abcdefgh"[i * i % 8] for i in range(50)) + "?page="
    few = " ".join(c * 12 for c in "Vwxyz")
    made = [plain]
    for j in (0, 1, 31, 32, 62, 63):
        made += [plain[:j] + "é" + plain[j + 1 :], plain[:j] + plain[j + 1 :], plain[:j] + "\U0001f600" + plain[j:]]
    made += [plain[:10] + "ab" + plain[12:], plain[:40] + plain[42:], plain[::-1], plain[:30] + " " + plain[30:]]
    made += [url + "1", url + "2", url + "10", url.upper() + "123", few, "\t" + few.replace(" ", "  ") + " ", few + "z", few.replace("w", "q", 1)]
    made += [few[:30] + few[32:], "x" * 60, "x" * 61, "x" * 62, "x" * 59, "y" * 59, " ".join("y" * 9), " ".join(plain), " ".join(plain)[:-1] + "z"]
    rows = [(7 * k % 101, line) for k, line in enumerate(made)]
    rows += [(500, "\n".join([few, "short", "", plain[:60], plain + "a"])), (None, plain + "bc"), (None, "own" * 21), (501, "own" * 21), (502, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(lines.duplicate_lines(df, min_chars=60, near_chars=60)) == brute_by_sort(rows)


def test_long_line_without_spaces(spark):
    text = "".join(chr(0x3400 + i * i % 20011) for i in range(300_000))
    rows = [(1, text), (2, text[:150_000] + "x" + text[150_001:]), (3, text[:7] + text[8:]), (4, text[:7] + text[9:])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(lines.duplicate_lines(df, min_chars=60, near_chars=60)) == {(2, 0): 1, (3, 0): 1, (4, 0): 1}


def test_odd_rows_by_code_points(spark):
    df = hp.odd_docs(spark)
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert got(lines.duplicate_lines(df, min_chars=60, near_chars=60)) == brute_by_sort(rows)
    assert lines.duplicate_lines(hp.empty_docs(spark), min_chars=60, near_chars=60).count() == 0
