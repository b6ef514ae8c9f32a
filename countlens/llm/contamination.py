"""Benchmark decontamination (operator 5): a positional inverted index over the training texts.

The index is stored as segments: each holds the postings of some neighbouring
documents' tokens, by term, with positions in ascending order (a gap lies
between documents, so no phrase crosses them). A segment is built in one task
from about ``SEGMENT`` tokens and searched in one task, so nothing is shuffled
and a term that stands in every text is spread over all segments.

A phrase is found from its rarest term: that term's positions, less its offset
in the phrase, are the candidate starts; the next rarest term's offset-adjusted
positions are intersected with them, and so on until none are left. Phrases are
broadcast in blocks of items whose windows take about ``BLOCK_BYTES``.

Defined results: null and empty texts have no words and no hits; an item
without words has no window; items of equal text all count; a null item id is
left out; repeated documents are indexed and reported one by one; with an empty
benchmark every document has no hits. Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from countlens.llm import text as tx
from countlens.llm.common import stored

SEGMENT = 1 << 21
BLOCK_BYTES = 32 << 20
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def build_index(docs: DataFrame, *, id_col="doc_id", text_col="text", segment: int = SEGMENT) -> DataFrame:
    """The stored index: a row per segment.

    ``doc_ids`` and ``n_words`` list its documents in order; ``terms`` are the
    sorted term hashes, ``starts`` where each term's postings begin, and
    ``positions`` the postings, as differences within a term.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    arrow_id = to_arrow_type(docs.schema[id_col].dataType)

    def segments(batches):
        ids, hashes, counts, size = [], [], [], 0

        def flush():
            n_words = np.concatenate(counts)
            h = np.concatenate(hashes)
            position = np.arange(len(h)) + np.repeat(np.arange(len(n_words)), n_words)
            order = np.argsort(h, kind="stable")
            h, position = h[order], position[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = h[1:] != h[:-1]
            starts = np.flatnonzero(new)
            gaps = np.diff(position, prepend=0)
            gaps[starts] = position[starts]
            columns = (n_words.astype("<i8"), h[starts], starts.astype("<i8"), gaps.astype("<u4"))
            return pa.RecordBatch.from_arrays(
                [pa.array([[x for c in ids for x in c.to_pylist()]], pa.list_(arrow_id))]
                + [pa.array([c.tobytes()], pa.binary()) for c in columns],
                ["doc_ids", "n_words", "terms", "starts", "positions"],
            )

        for batch in batches:
            for part in tx.slices(batch, "text"):
                h, at = tx.words(part.column(1), tx.ALNUM)
                ids.append(part.column(0))
                hashes.append(h)
                counts.append(np.diff(at))
                size += len(h) + part.num_rows
                if size >= segment:
                    yield flush()
                    ids, hashes, counts, size = [], [], [], 0
        if ids:
            yield flush()

    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    schema = f"doc_ids array<{id_type}>, n_words binary, terms binary, starts binary, positions binary"
    return stored(rows.mapInArrow(segments, schema), "positional-index", "zstd")


class Segment:
    """Postings of one segment."""

    def __init__(self, n_words: bytes, terms: bytes, starts: bytes, positions: bytes):
        self.n_words = np.frombuffer(n_words, "<i8")
        self.terms = np.frombuffer(terms, "<u8")
        self.starts = np.append(np.frombuffer(starts, "<i8"), len(positions) // 4)
        self.gaps = np.frombuffer(positions, "<u4")
        self.first = np.cumsum(self.n_words + 1) - self.n_words - 1  # position of each document's first word
        self.known: dict[int, np.ndarray] = {}

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Number of each term here, -1 where it is absent."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        k = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[k] == terms, k, -1)

    def df(self, k: np.ndarray) -> np.ndarray:
        return np.where(k < 0, 0, self.starts[k + 1] - self.starts[k])

    def postings(self, k: int) -> np.ndarray:
        if k not in self.known:
            self.known[k] = np.cumsum(self.gaps[self.starts[k] : self.starts[k + 1]], dtype=np.int64)
        return self.known[k]

    def phrase(self, ks: np.ndarray, dfs: np.ndarray) -> np.ndarray:
        """Positions at which the terms ``ks`` stand one after another."""
        order = np.argsort(dfs, kind="stable")
        at = self.postings(int(ks[order[0]])) - order[0]
        for o in order[1:]:
            if not len(at):
                break
            other = self.postings(int(ks[o]))
            near = np.minimum(np.searchsorted(other, at + o), len(other) - 1)
            at = at[other[near] == at + o]
        return at

    def near(self, ks: np.ndarray, dfs: np.ndarray, span: int) -> np.ndarray:
        """Positions of the rarest term within whose ``span`` words on either side, in
        the same document, every other term stands."""
        order = np.argsort(dfs, kind="stable")
        at = self.postings(int(ks[order[0]]))
        for o in order[1:]:
            other = self.postings(int(ks[o]))
            low = np.maximum(at - span, self.doc_first(at))
            high = np.minimum(at + span, self.doc_last(at))
            at = at[np.searchsorted(other, high, side="right") > np.searchsorted(other, low)]
        return at

    def doc(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, at, side="right") - 1

    def doc_first(self, at):
        return self.first[self.doc(at)]

    def doc_last(self, at):
        d = self.doc(at)
        return self.first[d] + self.n_words[d] - 1


def windows(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
    """Distinct windows of the texts: term hashes end to end, offsets, and the texts of each."""
    h, at = tx.words(pa.array(texts, pa.large_string()), tx.ALNUM)
    of: dict[bytes, set[int]] = defaultdict(set)
    for i in range(len(texts)):
        own = h[at[i] : at[i + 1]]
        for s in range(max(len(own) - size + 1, min(1, len(own)))):
            of[own[s : s + size].tobytes()].add(i)
    flat = np.frombuffer(b"".join(of), "<u8") if of else np.zeros(0, "<u8")
    offsets = np.concatenate([[0], np.cumsum([len(k) // 8 for k in of])]).astype(np.int64)
    return flat, offsets, [sorted(v) for v in of.values()]


def _blocks(items: DataFrame, item_col: str, text_col: str, size: int) -> list[DataFrame]:
    """The items in blocks whose windows take about ``BLOCK_BYTES`` each, so that each may be broadcast.

    Rows are dealt by item and text, so texts that share an id don't share a block;
    one text is never split.
    """
    items = items.filter(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))
    items = items.dropDuplicates(["item", "text"])
    words = F.regexp_count("text", F.lit(WORD))
    total = items.agg(F.sum(words * size * 8)).first()[0] or 0  # a window a word, a hash of 8 bytes a word of it
    n = -(-total // BLOCK_BYTES) or 1
    if n == 1:
        return [items]
    dealt = stored(items.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(n))), "items")
    return [dealt.filter(F.col("part") == i).drop("part") for i in range(n)]


def search(
    index: DataFrame, items: DataFrame, *, size: int = 13, span: int | None = None, item_col="item_id", text_col="text"
) -> DataFrame:
    """Per indexed document: ``doc_id``, ``n_words``, ``hits`` (merged [start, end) word ranges
    covered by occurrences) and ``items`` (ids with an occurrence).

    Without ``span``, occurrences are exact runs of ``size`` consecutive item
    words. With it, an item's window occurs where its rarest term stands with
    all its other terms at most ``span`` words away; that term's place is the hit.
    """
    spark = index.sparkSession
    id_type = index.schema["doc_ids"].dataType.elementType.simpleString()
    item_type = items.schema[item_col].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, hits array<struct<start:long,`end`:long>>, items array<{item_type}>"
    found = []
    blocks = _blocks(items, item_col, text_col, size)
    for block in blocks:
        rows = block.toArrow()
        arrow_item, names = rows.schema.field("item").type, rows.column("item").to_pylist()
        shared = spark.sparkContext.broadcast((names, *windows(rows.column("text").to_pylist(), size)))

        def run(batches, shared=shared, arrow_item=arrow_item):
            names, flat, offsets, of = shared.value
            out_type = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            for batch in batches:
                for r in range(batch.num_rows):
                    ids = batch.column(0)[r].values
                    seg = Segment(*(batch.column(i)[r].as_buffer() for i in range(1, 5)))
                    ks = seg.find(flat)
                    dfs = seg.df(ks)
                    whole = np.minimum.reduceat(ks, offsets[:-1]) >= 0 if len(flat) else np.zeros(0, bool)
                    cover = np.zeros(int((seg.n_words + 1).sum()) + 1, np.int32)
                    at_doc: dict[int, set[int]] = defaultdict(set)
                    for w in np.flatnonzero(whole):
                        a, b = offsets[w], offsets[w + 1]
                        if span is None:
                            at, length = seg.phrase(ks[a:b], dfs[a:b]), b - a
                        else:
                            at, length = seg.near(ks[a:b], dfs[a:b], span), 1
                        if len(at):
                            np.add.at(cover, at, 1)
                            np.add.at(cover, at + length, -1)
                            for d in np.unique(seg.doc(at)).tolist():
                                at_doc[d].update(of[w])
                    hit = np.cumsum(cover) > 0
                    begins = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1]]))
                    ends = np.flatnonzero(hit & ~np.concatenate([hit[1:], [False]])) + 1
                    d = seg.doc(begins)
                    runs = pa.StructArray.from_arrays(
                        [pa.array(begins - seg.first[d]), pa.array(ends - seg.first[d])], fields=list(out_type)
                    )
                    cut = pa.array(np.searchsorted(d, np.arange(len(ids) + 1)).astype(np.int32))
                    lists = [sorted({names[i] for i in at_doc[k]}) if k in at_doc else [] for k in range(len(ids))]
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids,
                            pa.array(seg.n_words),
                            pa.ListArray.from_arrays(cut, runs),
                            pa.array(lists, pa.list_(arrow_item)),
                        ],
                        ["doc_id", "n_words", "hits", "items"],
                    )

        found.append(run)
    if len(found) == 1:
        return index.mapInArrow(found[0], schema)
    return _joined([index.mapInArrow(run, schema) for run in found])


def _joined(results: list[DataFrame]) -> DataFrame:
    """Results of several blocks of items, document by document: each keeps the index's order."""
    place = [r.withColumn("place", F.monotonically_increasing_id()) for r in results]
    out = place[0]
    for more in place[1:]:
        more = more.select("place", F.col("hits").alias("more_hits"), F.col("items").alias("more_items"))
        out = out.join(more, "place").select(
            "place",
            "doc_id",
            "n_words",
            F.concat("hits", "more_hits").alias("hits"),
            F.array_union("items", "more_items").alias("items"),
        )
    merged = F.reduce(
        F.array_sort("hits"),
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= x["start"]),
            F.concat(
                F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.try_element_at(acc, F.lit(-1))["start"].alias("start"),
                        F.greatest(F.try_element_at(acc, F.lit(-1))["end"], x["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )
    return out.select("doc_id", "n_words", merged.alias("hits"), "items")
