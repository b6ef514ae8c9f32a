"""Language identification (operator 2): multinomial naive Bayes over hashed character n-grams.

Counts of hashed character n-grams per language come from all training texts:
each task sums its own partition's, Spark sums those. The log-probability
matrix has a fixed number of rows and one column per language, is checked
against a bound, and is broadcast. Texts are scored whole, in Arrow batches: the
rows of the matrix at a text's n-grams are summed.

Defined results: a null text or one without a letter is ``und`` with score 0,
as is any text when nothing could be learned; equal sums go to the first
language by code point; a null id is never held out and never learned from;
repeated rows are learned from and predicted one by one. Columns beyond those
named are ignored.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countlens.llm import text as tx
from countlens.llm.common import stored

UNKNOWN = "und"
MAX_LANGS = 2000  # the matrix then has at most 2**16 x 2000 float32, 0.5 GB

CELLS = 1 << 24  # numbers that scoring looks up at once, 64 MB

_BMP = [chr(i) for i in range(0x10000)]
_LOWER = np.array([ord(c.lower()) if len(c.lower()) == 1 else i for i, c in enumerate(_BMP)], dtype=np.uint32)
_LETTER = np.array([c.isalpha() for c in _BMP], dtype=bool)
del _BMP


def held_out(id_col: str = "doc_id", folds: int = 5):
    """Column: the remainder of the id's crc32 is 0; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def code_points(column) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of a string column and the n + 1 offsets of its rows."""
    data, at = tx.utf8(column)
    if not len(data):
        return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
    wide = "utf-32-le" if sys.byteorder == "little" else "utf-32-be"
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode(wide, "surrogatepass"), np.uint32)
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    small = points < 0x10000
    lowered = np.where(small, _LOWER[np.where(small, points, 0)], points).astype(np.uint32)
    return lowered, begins[at]


def has_letter(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    small = points < 0x10000
    yes = _LETTER[np.where(small, points, 0)] & small
    for c in np.unique(points[~small]).tolist():
        if chr(c).isalpha():
            yes |= points == c
    return np.diff(np.concatenate([[0], np.cumsum(yes)])[at]) > 0


def ngrams(points: np.ndarray, at: np.ndarray, sizes: tuple[int, ...], bits: int):
    """For each n: hashed n-grams within rows (bucket numbers) and their row offsets."""
    p = points.astype(np.uint64)
    for n in sizes:
        count = np.maximum(np.diff(at) - n + 1, 0)
        if len(p) < n:
            yield np.zeros(0, np.int64), np.zeros(len(at), np.int64)
            continue
        h = np.full(len(p) - n + 1, n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + p[k : len(p) - n + 1 + k]
        h = (h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)
        inside = np.zeros(len(p) + 1, np.int32)
        np.add.at(inside, at[:-1][count > 0], 1)
        np.add.at(inside, (at[:-1] + count)[count > 0], -1)
        yield h[np.cumsum(inside)[: len(h)] > 0].astype(np.int64), np.concatenate([[0], np.cumsum(count)])


def learn(train: DataFrame, *, text_col="text", lang_col="lang", sizes=(2, 3), bits=16, smooth=0.5):
    """Languages in code-point order and the (2**bits, languages) matrix of log probabilities, log priors."""

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in tx.slices(batch, "text"):
                langs = np.array(part.column(0).to_pylist(), dtype=object)
                points, at = code_points(part.column(1))
                rows = [(h, np.repeat(np.arange(len(a) - 1), np.diff(a))) for h, a in ngrams(points, at, sizes, bits)]
                for lang in set(langs.tolist()):
                    own = langs == lang
                    total = sums.setdefault(lang, np.zeros(2**bits + 1, np.int64))
                    total[-1] += int(own.sum())
                    for h, row in rows:
                        total[:-1] += np.bincount(h[own[row]], minlength=2**bits)
        for lang, total in sums.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(seen), pa.string()), pa.array(seen.astype(np.int32)), pa.array(total[seen])],
                ["lang", "bucket", "n"],
            )

    rows = train.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang is not null")
    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = stored(counts, "langid-counts")
    langs = [r[0] for r in counts.select("lang").distinct().orderBy("lang").limit(MAX_LANGS + 1).collect()]
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages: the matrix would not be small")
    got = counts.toArrow()
    matrix = np.zeros((2**bits + 1, max(1, len(langs))))
    at = {lang: i for i, lang in enumerate(langs)}
    column = np.array([at[x] for x in got.column("lang").to_pylist()], dtype=np.int64)
    matrix[got.column("bucket").to_numpy(), column] = got.column("n").to_numpy()
    docs, grams = matrix[-1], matrix[:-1]
    logs = np.log((grams + smooth) / (grams.sum(axis=0) + smooth * 2**bits)).astype(np.float32)
    prior = np.log(np.maximum(docs, 1) / max(docs.sum(), 1))
    return langs, logs, prior


def predict(docs: DataFrame, model, *, id_col="doc_id", text_col="text", sizes=(2, 3), bits=16, cells: int = CELLS) -> DataFrame:
    """Per document: id, ``held_out``, ``lang_pred`` and ``score``, the posterior of the prediction.

    ``cells``: numbers of the matrix that are looked up at once, in a task.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def score(batches):
        langs, logs, prior = shared.value
        limit = max(1, cells // max(1, len(langs)))  # n-grams at a time, whatever the languages
        for batch in batches:
            for part in tx.slices(batch, "text", 1 << 20):
                points, at = code_points(part.column(2))
                total = np.tile(prior, (len(at) - 1, 1))
                for h, a in ngrams(points, at, sizes, bits):
                    full = np.flatnonzero(np.diff(a))
                    for lo, hi in tx.pieces(np.diff(a)[full], limit):
                        own = full[lo:hi]
                        s, e = a[own[0]], a[own[-1] + 1]
                        if e - s <= limit:
                            total[own] += np.add.reduceat(logs[h[s:e]], a[own] - s, axis=0, dtype=np.float64)
                        else:  # one very long text, in blocks
                            for b in range(s, e, limit):
                                total[own[0]] += logs[h[b : min(b + limit, e)]].sum(axis=0, dtype=np.float64)
                known = has_letter(points, at) & bool(langs)
                best = total.argmax(axis=1)
                odds = np.exp(total - total.max(axis=1, keepdims=True))
                posterior = odds.max(axis=1) / odds.sum(axis=1)
                names = np.array([*langs, UNKNOWN], dtype=object)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(names[np.where(known, best, -1)].tolist(), pa.string()),
                        pa.array(np.where(known, posterior, 0.0)),
                    ],
                    [id_col, "held_out", "lang_pred", "score"],
                )

    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(score, f"`{id_col}` {id_type}, held_out boolean, lang_pred string, score double")
