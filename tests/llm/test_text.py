import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from countlens.llm import text as tx
from tests.llm import helpers as hp

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ z09-.\t\n\x0b\x1cé漢😀", max_size=40)), max_size=8)
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words_equal_where_the_pattern_says_so(texts):
    for kind, cut in ((tx.SPACED, hp.spaced_words), (tx.ALNUM, lambda t: ALNUM.findall((t or "").encode().lower()))):
        h, at = tx.words(pa.array(texts, pa.string()), kind)
        want = [cut(t) for t in texts]
        assert np.diff(at).tolist() == [len(w) for w in want]
        flat = [w for ws in want for w in ws]
        assert len(set(flat)) == len(set(h.tolist()))
        assert all((a == b) == (x == y) for a, x in zip(flat, h, strict=True) for b, y in zip(flat, h, strict=True))


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_shingles(texts):
    h, at = tx.words(pa.array(texts, pa.string()), tx.SPACED)
    s, out = tx.shingles(h, at, 3)
    want = []
    for t in texts:
        w = hp.spaced_words(t)
        want.append([tuple(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [tuple(w)] if w else [])
    assert np.diff(out).tolist() == [len(x) for x in want]
    flat = [x for xs in want for x in xs]
    assert len(set(flat)) == len(set(s.tolist()))


def test_a_word_longer_than_the_power_table():
    long = "x" * 5000
    h, _ = tx.words(pa.array([long, long + "y", long, "x" * 64, "x" * 65]), tx.SPACED)
    assert h[0] == h[2] and len(set(h.tolist())) == 4


def test_pieces_keep_every_row_whole():
    sizes = np.array([5, 5, 100, 1, 1, 1])
    assert tx.pieces(sizes, 10) == [(0, 2), (2, 3), (3, 6)]
    assert tx.pieces(np.zeros(0, int), 10) == []


def test_sliced_arrow_columns():
    a = pa.array(["zero", None, "ab cd", "ef"]).slice(1)
    data, at = tx.utf8(a)
    assert bytes(data) == b"ab cdef" and at.tolist() == [0, 0, 5, 7]
