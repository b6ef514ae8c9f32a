"""Line dedup (operator 8): a deletion-neighbourhood join over the words of lines.

A line is the sequence of its words (white space apart, A-Z lowered). Lines of
fewer than ``min_words`` words are left alone, unless ``min_chars`` is given and their words,
with a blank between two, have that many code points (text without spaces, long
URLs). Lines of at least ``near_words`` words are near if one word inserted, deleted or
replaced makes them equal. Given ``near_chars``, lines of fewer words but that many code
points (counted likewise) are near if one code point inserted, deleted or replaced does: text
without spaces, URLs, code, few long words. A line of one sort is never near to one of the
other. Of equal or near lines the earliest, by document id and line number, stays: a line
goes if an earlier line equals it or is near to it, also if that one goes itself.

Below, tokens are a line's words, or its code points where those decide.

1. Equal lines meet in one aggregate, which keeps each line's first place.
2. Two near lines share the first or the last half of the shorter one's tokens,
   so only lines that share such a half with another line go on.
3. Those emit their variants: a hash of the line, and one for each token left
   out. Lines that are equal but for the token at one place share that variant
   and place; a line with a token more has a variant that equals the other line.
   Each variant needs only its earliest line, so hot variants are aggregated
   before they are shuffled, and no pairs of a group are made.
4. The earliest partner found is verified on the tokens themselves.

Defined results: null text has no lines; empty text has one empty line; a null
id comes last; rows that repeat an id share their places, and lines that are
equal at one place are one line, so both rows keep it or lose it; other columns
are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countlens.llm import text as tx
from countlens.llm.common import bitmap, in_bitmap, stored

_U = np.uint64
_BASE = _U(0xB5297A4D3F84D5B5)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_CHAR = _U(0x3C79AC492BA7B653)


def _powers(n: int) -> np.ndarray:
    return tx.powers(_BASE, max(1, n))


class Lines(NamedTuple):
    """The lines of a column: token hashes and their offsets, and per line its row, number, bounds
    among the bytes, words, code points (a blank between two words) and whether it can have near lines."""

    h: np.ndarray
    at: np.ndarray
    row: np.ndarray
    number: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    n_words: np.ndarray
    n_chars: np.ndarray
    near: np.ndarray


class Bounds(NamedTuple):
    """From which size on lines have near ones."""

    near_words: int
    near_chars: int | None = None


def line_tokens(column, bounds: Bounds) -> Lines:
    data, at = tx.utf8(column)
    breaks = np.flatnonzero(data == 10)
    row = np.searchsorted(at, breaks, side="right") - 1
    begins = np.concatenate([at[:-1], breaks + 1])
    rows = np.concatenate([np.arange(len(at) - 1), row])
    order = np.lexsort((begins, rows))
    begins, rows = begins[order], rows[order]
    first = np.searchsorted(rows, np.arange(len(at) - 1))
    ends = np.empty_like(begins)
    if len(begins):
        last = np.append(rows[1:] != rows[:-1], True)
        ends[:-1] = begins[1:] - 1
        ends[last] = at[1:]
    low = tx.LOWER[data]
    starts, stops = tx.word_bounds(low, at, tx.SPACED)
    # A word's line is the last one that begins at or before it.
    word_at = np.append(np.searchsorted(starts, begins), len(starts))
    n_words = np.diff(word_at)
    leads = tx.SPACED[data] & ((data & 0xC0) != 0x80)
    chars = np.concatenate([[0], np.cumsum(leads)])
    n_chars = chars[ends] - chars[begins] + np.maximum(n_words - 1, 0)
    near = n_words >= bounds.near_words
    h, line_at = tx.hash_ranges(low, starts, stops), word_at
    if bounds.near_chars is not None:
        by_char = ~near & (n_chars >= bounds.near_chars)
        near |= by_char
        if by_char.any():
            h, line_at = _with_chars(h, low, starts, stops, word_at, leads, begins, ends, by_char)
    return Lines(h, line_at, rows, np.arange(len(rows)) - first[rows], begins, ends, n_words, n_chars, near)


def _with_chars(h, low, starts, stops, word_at, leads, begins, ends, by_char) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes and line offsets, with code points for the lines ``by_char`` and words for the others."""
    line = np.repeat(np.arange(len(by_char)), np.diff(word_at))
    edge = np.zeros(len(low) + 1, np.int64)
    np.add.at(edge, begins[by_char], 1)
    np.add.at(edge, ends[by_char], -1)
    point = np.flatnonzero(leads & (np.cumsum(edge[:-1]) > 0))
    size = 1 + (low[point] >= 0xC0).astype(np.int64) + (low[point] >= 0xE0) + (low[point] >= 0xF0)
    blank = stops[:-1][(line[:-1] == line[1:]) & by_char[line[:-1]]]
    begin = np.concatenate([point, blank])
    end = np.concatenate([point + size, blank + 1])
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], end[order]
    # Salted, so that no code point is taken for a word.
    own = tx.mix(tx.hash_ranges(np.where(tx.SPACED[low], low, np.uint8(32)), begin, end) ^ _CHAR)
    words = ~by_char[line]
    begin, h = np.concatenate([starts[words], begin]), np.concatenate([h[words], own])
    order = np.argsort(begin, kind="stable")
    begin, h = begin[order], h[order]
    return h, np.append(np.searchsorted(begin, begins), len(begin))


class Sums:
    """Prefix sums of token hashes by power of place, for hashes of any part of a line."""

    def __init__(self, h: np.ndarray, at: np.ndarray):
        self.at, self.n = at, np.diff(at)
        place = np.arange(len(h)) - np.repeat(at[:-1], self.n)
        power = _powers(int(self.n.max(initial=0)) + 1)
        self.power = power
        zero = np.zeros(1, _U)
        self.up = np.concatenate([zero, np.cumsum(h * power[place], dtype=_U)])
        self.down = np.concatenate([zero, np.cumsum(h * power[np.repeat(self.n, self.n) - 1 - place], dtype=_U)])

    def whole(self) -> np.ndarray:
        return tx.mix((self.up[self.at[1:]] - self.up[self.at[:-1]]) ^ self.n.astype(_U))

    def head(self, i: np.ndarray, p: np.ndarray) -> np.ndarray:
        return tx.mix((self.up[self.at[i] + p] - self.up[self.at[i]]) ^ (p.astype(_U) << _U(1)))

    def tail(self, i: np.ndarray, p: np.ndarray) -> np.ndarray:
        return tx.mix((self.down[self.at[i + 1]] - self.down[self.at[i + 1] - p]) ^ ((p.astype(_U) << _U(1)) + _U(1)))

    def deletions(self, i: int) -> np.ndarray:
        """For each token of line ``i``, the hash of the line without it."""
        a, b = self.at[i], self.at[i + 1]
        before = self.up[a:b] - self.up[a]
        after = (self.up[b] - self.up[a + 1 : b + 1]) * _INVERSE
        return tx.mix((before + after) ^ _U(b - a - 1))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).filter("text is not null")


def _place(doc="doc", line="line"):
    """Order of places: by id, null last, then line."""
    return F.struct(F.col(doc).isNull().alias("late"), F.col(doc).alias("doc"), F.col(line).alias("line"))


def _all_lines(rows: DataFrame, min_words: int, min_chars: int | None, bounds: Bounds) -> DataFrame:
    """(doc, line, h, halves) of each line of ``min_words`` words or ``min_chars`` code points or more."""
    id_type = rows.schema["doc"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in tx.slices(batch, "text"):
                found = line_tokens(part.column(1), bounds)
                sums = Sums(found.h, found.at)
                whole = found.n_words >= min_words
                if min_chars is not None:
                    whole |= found.n_chars >= min_chars
                use = np.flatnonzero(whole)
                n = sums.n[use]
                long = found.near[use]
                half, shorter = (n - 1) // 2, np.maximum(n - 2, 0) // 2
                keys = np.stack([sums.head(use, half), sums.tail(use, half), sums.head(use, shorter), sums.tail(use, shorter)], axis=1)
                width = np.where(long, np.where(half == shorter, 2, 4), 0)
                taken = np.arange(4)[None, :] < width[:, None]
                offsets = np.concatenate([[0], np.cumsum(width)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(found.row[use])),
                        pa.array(found.number[use]),
                        _signed(sums.whole()[use]),
                        pa.ListArray.from_arrays(pa.array(offsets), _signed(keys[taken])),
                    ],
                    ["doc", "line", "h", "halves"],
                )

    return rows.mapInArrow(run, f"doc {id_type}, line long, h long, halves array<long>")


def _near_texts(rows: DataFrame, candidates: DataFrame, bounds: Bounds) -> DataFrame:
    """The candidate lines' texts, by a second pass over the documents that hold them."""
    id_type = rows.schema["doc"].dataType.simpleString()
    docs = candidates.select(F.xxhash64("place.doc").alias("key"))
    shared = rows.sparkSession.sparkContext.broadcast((bitmap(docs, "key"), bitmap(candidates, "h")))

    def run(batches):
        docs, hashes = shared.value
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(docs, batch.column(2).to_numpy())))
            for part in tx.slices(batch, "text"):
                data, _ = tx.utf8(part.column(1))
                found = line_tokens(part.column(1), bounds)
                whole = Sums(found.h, found.at).whole()
                use = np.flatnonzero(in_bitmap(hashes, whole))
                raw = data.tobytes()
                texts = [raw[found.begins[i] : found.ends[i]].decode("utf-8", "replace") for i in use.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(found.row[use])), pa.array(found.number[use]), _signed(whole[use]), pa.array(texts, pa.string())],
                    ["doc", "line", "h", "text"],
                )

    rows = rows.select("doc", "text", F.xxhash64("doc").alias("key"))
    found = rows.mapInArrow(run, f"doc {id_type}, line long, h long, text string")
    found = found.select("h", _place().alias("place"), "text").join(candidates.select("h", "place"), ["h", "place"])
    return found.dropDuplicates(["h"])


def _variants(texts: DataFrame, bounds: Bounds) -> DataFrame:
    """(v, at, h, place): the line itself with ``at`` -1, and the line without its token ``at``."""
    place_type = texts.schema["place"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in tx.slices(batch, "text", 1 << 18):
                found = line_tokens(part.column(1), bounds)  # a line is a row here
                sums = Sums(found.h, found.at)
                whole = sums.whole()
                v = np.concatenate([np.append(whole[i], sums.deletions(i)) for i in range(len(whole))])
                size = sums.n + 1
                row = np.repeat(np.arange(len(size)), size)
                where = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) - 1
                for lo in range(0, len(row), 1 << 18):
                    own = slice(lo, lo + (1 << 18))
                    yield pa.RecordBatch.from_arrays(
                        [
                            _signed(v[own]),
                            pa.array(where[own].astype(np.int32)),
                            part.column(0).take(pa.array(row[own])),
                            part.column(2).take(pa.array(row[own])),
                        ],
                        ["v", "at", "h", "place"],
                    )

    return texts.select("h", "text", "place").mapInArrow(run, f"v long, `at` int, h long, place {place_type}")


def _words(text: str) -> list[str]:
    low = "".join(" " if c in " \t\n\v\f\r" else c.lower() if "A" <= c <= "Z" else c for c in text)
    return [w for w in low.split(" ") if w]


def one_apart(x, y) -> bool:
    """One item inserted, deleted or replaced at most."""
    if abs(len(x) - len(y)) > 1:
        return False
    head = 0
    while head < min(len(x), len(y)) and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    return max(len(x), len(y)) - head - tail <= 1


def one_word_apart(a: str, b: str) -> bool:
    """One word inserted, deleted or replaced at most, by the lines' words."""
    return one_apart(_words(a), _words(b))


def one_token_apart(a: str, b: str, bounds: Bounds) -> bool:
    """One token inserted, deleted or replaced at most, in lines of one sort."""
    x, y = _words(a), _words(b)
    by_word = [len(w) >= bounds.near_words or bounds.near_chars is None for w in (x, y)]
    if by_word[0] != by_word[1]:
        return False
    return one_apart(x, y) if by_word[0] else one_apart(" ".join(x), " ".join(y))


def near_lines(texts: DataFrame, bounds: Bounds) -> DataFrame:
    """Of the lines (h, place, text), those with an earlier near line: (h, earlier h)."""
    variants = stored(_variants(texts, bounds), "line-variants")
    best = variants.groupBy("v", "at").agg(F.min(F.struct("place", "h")).alias("first"), F.count("*").alias("n"))
    whole = F.col("at") == -1
    by_value = (
        best.groupBy("v")
        .agg(
            F.min(F.when(whole, F.col("first"))).alias("line_itself"),
            F.min(F.when(~whole, F.col("first"))).alias("line_longer"),
            F.sum("n").alias("n"),
        )
        .filter("n > 1")
        .drop("n")
    )
    same_place = best.filter("n > 1 and at >= 0").select("v", "at", F.col("first").alias("line_beside"))
    offers = variants.join(by_value, "v").join(same_place, ["v", "at"], "left")
    other = F.when(whole, F.col("line_longer")).otherwise(F.least("line_itself", "line_beside"))
    offers = offers.withColumn("other", other).filter(F.col("other.place") < F.col("place"))
    pairs = offers.groupBy("h").agg(F.min("other").alias("other")).select("h", F.col("other.h").alias("earlier"))

    def verify(batches):
        for batch in batches:
            ok = [one_token_apart(a, b, bounds) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["h", "earlier"]).filter(pa.array(ok, pa.bool_()))

    with_texts = (
        pairs.join(texts.select("h", F.col("text").alias("a")), "h")
        .join(texts.select(F.col("h").alias("earlier"), F.col("text").alias("b")), "earlier")
        .select("h", "earlier", "a", "b")
    )
    return with_texts.mapInArrow(verify, "h long, earlier long")


def duplicate_lines(
    docs: DataFrame,
    *,
    id_col="doc_id",
    text_col="text",
    min_words: int = 5,
    near_words: int = 9,
    min_chars: int | None = None,
    near_chars: int | None = None,
) -> DataFrame:
    """Each line that goes: id, ``line`` (from 0) and ``kind`` (``copy`` or ``near``)."""
    rows = _rows(docs, id_col, text_col)
    bounds = Bounds(near_words, near_chars)
    lines = stored(_all_lines(rows, min_words, min_chars, bounds), "lines")
    distinct = lines.groupBy("h").agg(F.min(_place()).alias("place"), F.count("*").alias("n"), F.first("halves").alias("halves"))
    distinct = stored(distinct, "lines-distinct")
    halves = distinct.select("h", "place", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half")
    candidates = stored(halves.join(shared, "half", "left_semi").select("h", "place").dropDuplicates(["h"]), "line-candidates")
    texts = stored(_near_texts(rows, candidates, bounds), "line-texts")
    near = near_lines(texts, bounds).select("h", F.lit(True).alias("near"))
    doubtful = distinct.join(near, "h", "left").filter("n > 1 or near").select("h", "place", "near")
    goes = F.col("near") | (_place() != F.col("place"))
    out = lines.select("doc", "line", "h").join(doubtful, "h").filter(F.coalesce(goes, _place() != F.col("place")))
    kind = F.when(_place() == F.col("place"), "near").otherwise("copy")
    return out.select(F.col("doc").alias(id_col), "line", kind.alias("kind"))


def drop_lines(docs: DataFrame, gone: DataFrame, *, id_col="doc_id", text_col="text") -> DataFrame:
    """The documents without the lines listed in ``gone``, other columns kept.

    A document left with no line at all has text null. Rows with a null id, which
    can't be told apart, are left as they are, and rows that repeat an id lose
    the same lines."""
    lists = gone.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.collect_set(F.col("line").cast("int")).alias("_gone"))
    # By line numbers as sets, so the work grows with a document's lines and not with their square.
    split = docs.join(lists, id_col, "left").withColumn("_lines", F.when(F.col("_gone").isNotNull(), F.split(F.col(text_col), "\n")))
    numbers = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone")
    kept = F.transform(numbers, lambda i: F.get(F.col("_lines"), i))
    text = F.when(F.col("_lines").isNull(), F.col(text_col)).when(F.size(numbers) > 0, F.array_join(kept, "\n"))
    return split.withColumn(text_col, text).drop("_gone", "_lines")
