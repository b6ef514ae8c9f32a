"""Secret scans (operator 6): patterns, and password guess cost by dynamic programming.

Base spans come from three patterns. The method adds spans: a value that stands
in a credential context is cut into words, dates, repeats, keyboard walks and
spans of brute force so that the bits to guess it are fewest; a repeat costs the
cheapest segmentation of its unit and the bits of its number. A value that still
costs ``min_bits`` or more, ``min_brute`` of them by brute force, is a ``guess``
span: identifiers and phrases put together from known words are none, however
long. Each text is scanned whole, by itself.

Words are ranked: first a list of frequent parts of passwords, then the
``max_words`` words that most documents have (``learn_words``), counted over all
whole texts but for the values in credential contexts, so that a secret that
many documents repeat doesn't become a word.

Defined results: null is an empty text, with no spans; repeated rows are
scanned one by one; an empty table teaches no words; of words in equally many
documents the first by code point ranks first; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countlens.llm import text as tx

# The contract's patterns.
_ASSIGN = re.compile(
    r"""(?a:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CONTEXT = re.compile(
    r"""(?ai)(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credential|api[_-]?key|(?:access|private|auth)[_-]?key)s?["']?"""
    r"""[\x20\t]*(?:[:=]>?|\x20is\x20)[\x20\t]*["']?([^\s"'`,;<>]{6,})"""
)
_HINTS = ("pass", "pwd", "secret", "token", "credential", "key")
KINDS = ("assign", "access", "hex", "guess")

# Frequent parts of chosen passwords, most frequent first.
WORDS = (
    "password pass admin root user test guest login welcome master secret token letmein love monkey dragon "
    "football baseball shadow sunshine princess superman iloveyou hello freedom whatever trust summer winter spring "
    "autumn monday friday january march april june july august october december michael jordan hunter ranger "
    "changeme default example sample demo temp temporary null none true false your enter here insert replace "
    "placeholder dummy fake public private access service server client system manager office company backup "
    "database mysql oracle postgres redis docker local host internet network secure security key code orange "
    "apple banana cookie coffee cheese flower silver golden purple yellow green black white blue red"
).split()
_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_SHAPES = str.maketrans("4310$57@", "aeiossta")
_DATE = re.compile(
    r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d"
)
_YEAR = re.compile(r"(?:19|20)\d\d")
_BITS_JOIN = 1.0
#: Longest unit of a repeat. A longer one holds enough bits itself, or next to no brute force.
MAX_UNIT = 64
#: Characters of the first prefix of a value that is looked at.
FIRST_LOOK = 512
_LEARNED = re.compile(r"(?<![^\W\d_])[^\W\d_]{3,24}(?![^\W\d_])")
HELD = 200_000  # words counted in a task before they go on


def _beside() -> set[tuple[str, str]]:
    pairs = set()
    for row in _ROWS:
        pairs |= set(zip(row, row[1:], strict=False))
    for upper, lower in zip(_ROWS, _ROWS[1:], strict=False):
        pairs |= set(zip(upper, lower, strict=False)) | set(zip(upper[1:], lower, strict=False))
    letters = "abcdefghijklmnopqrstuvwxyz"
    pairs |= set(zip(letters, letters[1:], strict=False))
    return pairs | {(b, a) for a, b in pairs}


_BESIDE = _beside()


def _char_bits(c: str) -> float:
    if c.isdigit():
        return math.log2(10)
    if c.isascii() and c.isalpha():
        return math.log2(26)
    return math.log2(33) if c.isascii() else 12.0


def _plain(value: str) -> str:
    """Lower case, character by character, so that places stay."""
    return "".join(x if len(x := c.lower()) == 1 else c for c in value)


def repeats(value: str) -> list[list[tuple[int, int]]]:
    """Per place, (unit, times) of the repeats that begin there: units of up to ``MAX_UNIT`` characters
    that are no repeats themselves, with the most times they stand in a row."""
    codes = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), np.uint32)
    at: list[list[tuple[int, int]]] = [[] for _ in range(len(value))]
    for unit in range(1, min(MAX_UNIT, len(value) // 2) + 1):
        same = np.concatenate([[False], codes[:-unit] == codes[unit:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            for i in range(begin, end - unit + 1):
                if not any(unit % u == 0 and u * times >= unit for u, times in at[i]):
                    at[i].append((unit, (end - i) // unit + 1))
    return at


def _segments(value: str, words: dict[str, int], longest: int):
    """Per place, the (end, bits) of the words, dates, repeats and walks that begin there."""
    n, low = len(value), _plain(value)
    plain = low.translate(_SHAPES)
    walk = [0] * n  # characters of the keyboard walk that ends here
    for i in range(n):
        walk[i] = walk[i - 1] + 1 if i and (low[i - 1], low[i]) in _BESIDE else 1
    again = repeats(value)
    for i in range(n):
        out = []
        for j in range(i + 3, min(n, i + longest) + 1):
            rank = words.get(low[i:j]) or words.get(plain[i:j])
            if rank:
                part = value[i:j]
                odd = 0.0 if part == low[i:j] else 1.0 if part.istitle() or part.isupper() else 0.5 * (j - i)
                odd += 0.0 if low[i:j] in words else 2.0
                out.append((j, math.log2(rank + 1) + odd))
        if value[i].isdigit():
            for pattern, bits in ((_YEAR, math.log2(200)), (_DATE, math.log2(200 * 366))):
                if m := pattern.match(value, i):
                    out.append((m.end(), bits))
        for unit, most in again[i]:
            inner, brute = cheapest(value[i : i + unit], words, longest=longest)
            for times in {*range(2, min(most, 16) + 1), most}:
                if unit * times >= 3:
                    out.append((i + unit * times, inner + math.log2(times), brute))
        j = i + 1
        while j < n and j - i < 64 and walk[j] > j - i:
            j += 1
            if j - i >= 3:
                out.append((j, math.log2(47) + 1.5 * math.log2(j - i) + 1))
        yield out


def cheapest(
    value: str, words: dict[str, int], enough: tuple[float, float] = (math.inf, math.inf), longest: int | None = None
) -> tuple[float, float]:
    """Bits of the cheapest segmentation of ``value``, and how many of them are brute force.

    ``words`` gives ranks from 1. Both figures only grow along a segmentation, and every
    one of the whole value passes the last places of each of its prefixes; so where all
    of those have ``enough`` of both, the rest needn't be looked at and lower bounds are
    returned. Prefixes are tried in growing sizes.
    """
    longest = max(map(len, words), default=0) if longest is None else longest
    size = FIRST_LOOK if min(enough) < math.inf else len(value)
    while True:
        part = value[:size]
        best = [(0.0, 0.0)] + [(math.inf, 0.0)] * len(part)
        for i, found in enumerate(_segments(part, words, longest)):
            bits, brute = best[i]
            c = _char_bits(part[i])
            best[i + 1] = min(best[i + 1], (bits + c, brute + c))
            for end, cost, *of_brute in found:
                best[end] = min(best[end], (bits + _BITS_JOIN + cost, brute + sum(of_brute)))
        if size >= len(value):
            return best[-1]
        last = best[-max(64, longest, MAX_UNIT + 1) - 1 :]
        if all(x[0] >= enough[0] and x[1] >= enough[1] for x in last):
            return min(x[0] for x in last), min(x[1] for x in last)
        size *= 8


def guess_bits(value: str, words: dict[str, int]) -> float:
    """Bits of the cheapest way to guess ``value`` part by part; ``words`` gives ranks from 1."""
    return cheapest(value, words)[0]


def find_spans(
    text: str, words: dict[str, int], min_bits: float, min_brute: float = 0.0, longest: int | None = None
) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all spans, in order."""
    found = [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    low = text.lower()
    if any(h in low for h in _HINTS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
        for m in _CONTEXT.finditer(text):
            bits, brute = cheapest(m[1], words, (min_bits, min_brute), longest)
            if bits >= min_bits and brute >= min_brute:
                found.append((m.start(1), 3, m.end(1)))
    return sorted(found)


def learn_words(docs: DataFrame, *, text_col="text", max_words: int = 20_000, min_docs: int = 3) -> list[str]:
    """``WORDS``, then the words of 3 to 24 letters that most documents have: at most ``max_words`` of
    them, each in ``min_docs`` documents or more."""

    def run(batches):
        held: Counter = Counter()

        def flush():
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()

        for batch in batches:
            for text in batch.column(0):
                low = _plain(text.as_py() or "")
                if any(h in low for h in _HINTS):
                    low = _CONTEXT.sub(" ", low)
                held.update({m[0] for m in _LEARNED.finditer(low)})
                if len(held) >= HELD:
                    yield from flush()
        yield from flush()

    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    counts = counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs)
    found = counts.orderBy(F.desc("n"), "word").limit(max_words).select("word").toArrow().column(0).to_pylist()
    known = set(WORDS)
    return [*WORDS, *(w for w in found if w not in known)]


def scan(
    docs: DataFrame, *, id_col="doc_id", text_col="text", min_bits: float = 36.0, min_brute: float = 20.0, words=WORDS
) -> DataFrame:
    """Per document: id, counts per base kind, ``base_sha256`` and ``spans`` (kind:start:end, comma-joined)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    longest = max(map(len, words), default=0)
    shared = docs.sparkSession.sparkContext.broadcast({w: i + 1 for i, w in reversed(list(enumerate(words)))})

    def run(batches):
        ranks = shared.value
        for batch in batches:
            for part in tx.slices(batch, "text"):
                out = []
                for text in part.column(1).to_pylist():
                    spans = find_spans(text or "", ranks, min_bits, min_brute, longest)
                    base = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans if k < 3)
                    counts = [sum(1 for x in spans if x[1] == k) for k in range(3)]
                    every = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
                    out.append((*counts, hashlib.sha256(base.encode()).hexdigest(), every))
                kinds = [pa.int64()] * 3 + [pa.string()] * 2
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                names = [id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)

    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        run, f"`{id_col}` {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )
