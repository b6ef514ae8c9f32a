"""Suffix-array dedup (operator 10): repeated byte strings, from common-prefix interval trees.

A byte goes if it lies in a string of ``length`` bytes (200) that also starts
anywhere else. Sorting all suffixes of a corpus is not needed for that: only
places that share an anchor can repeat.

Anchors. Of the grams of 32 bytes within a window of 200 bytes, the one of the
least hash (the leftmost of equals) is the window's anchor. Equal windows have
equal anchors at equal offsets, so a window can only repeat one whose anchor is
the same gram. The windows of one anchor are neighbours; the bytes they span
are the anchor's context.

Equal contexts. Contexts are counted by hash, combined before the shuffle: the
windows of a context that occurs twice all repeat. Only anchors with contexts
that differ go on, one copy of each context.

Suffix array. The contexts of an anchor gram (many grams to a task, streamed)
are searched together: their suffixes that share 200 bytes with another and
whose left extensions differ are sorted, common prefixes of neighbours are
counted, and a stack scan over them yields the intervals of the common-prefix
tree. An interval whose members have different bytes to the left is a maximal
repeat of its anchor's context. It is put out with all its occurrences, each
once, at the longest repeat that it is one of, with the repeat that encloses
that one: rows in proportion to the suffixes, however deep the tree. An
anchor gram with more than ``many`` different contexts is not gathered in a
task: its windows are counted by hash in a plain aggregate.

Repeats are judged on the input; spans merge over contexts within a document,
so a long repeat comes out whole there.

Defined results: null text is empty; texts below 200 bytes keep all; rows that
repeat an id and text are copies of each other; a null id is kept as null;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countlens.llm import text as tx
from countlens.llm.common import bitmap, in_bitmap, parts, stored

_U = np.uint64
GRAM = 32
CHUNK = 1 << 16  # window starts handled at a time: arrays that stay in a core's cache
TASK_BYTES = 4 << 20  # context bytes searched together
_R = _U(0xC2B2AE3D27D4EB4F)
_BYTES = tx.mix(np.arange(256, dtype=_U) + _U(0x1234567))


def _power(n: int) -> np.uint64:
    return _U(pow(int(_R), n, 1 << 64))


def rolling(data: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of all strings of each size (a size is a sum of powers of two, smallest sizes last)."""
    level, grown, need = 1, {1: _BYTES[data]}, max(sizes)
    while level * 2 <= need and len(grown[level]) > level:
        h = grown[level]
        grown[level * 2] = h[:-level] * _power(level) + h[level:]
        level *= 2
    out = []
    for size in sizes:
        n = len(data) - size + 1
        if n <= 0:
            out.append(np.zeros(0, _U))
            continue
        bits = [1 << k for k in range(size.bit_length() - 1, -1, -1) if size >> k & 1]
        h, at = grown[bits[0]][:n], bits[0]
        for b in bits[1:]:
            h = h * _power(b) + grown[b][at : at + n]
            at += b
        out.append(tx.mix(h))
    return out


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of each run of ``width`` keys."""
    level, low = 1, keys
    while level * 2 <= width:
        low = np.minimum(low[:-level], low[level:])
        level *= 2
    n = len(keys) - width + 1
    return np.minimum(low[:n], low[width - level : width - level + n])


def anchors(data: np.ndarray, at: np.ndarray, length: int):
    """Contexts of the rows' anchors: (row, first window, windows - 1, gram hash, context hash).

    Windows are numbered from the start of ``data``.
    """
    found = []
    for c in range(0, max(1, len(data)), CHUNK):
        piece = data[c : c + CHUNK + length - 1]
        if len(piece) < length:
            break
        (gram,) = rolling(piece, (GRAM,))
        place = np.arange(len(gram), dtype=_U)
        least = sliding_least(((gram >> _U(21)) << _U(21)) | place, length - GRAM + 1)
        anchor = (least & _U((1 << 21) - 1)).astype(np.int32)
        # The rows of the chunk, and the last window start of each.
        lo, hi = np.searchsorted(at, [c, c + len(anchor) - 1], side="right") - 1
        inside = np.minimum(at[lo + 1 : hi + 2], c + len(anchor)) - np.maximum(at[lo : hi + 1], c)
        row = np.repeat(np.arange(lo, hi + 1, dtype=np.int32), inside)
        ok = np.arange(c, c + len(anchor)) <= np.repeat(at[lo + 1 : hi + 2] - length, inside)
        new = np.ones(len(anchor) + 1, bool)
        new[1:-1] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (ok[1:] != ok[:-1])
        first = np.flatnonzero(new[:-1] & ok)
        last = np.flatnonzero(new[1:] & ok)
        width = last - first
        context = width.astype(_U)
        for k in range((2 * length - GRAM) // GRAM + 1):  # grams end to end, the last one at the end
            spot = np.minimum(first + k * GRAM, last + length - GRAM)
            context = context * _U(0x9FB21C651E98DF25) + gram[spot]
        found.append((row[first].astype(np.int64), first + c, width, gram[anchor[first]], tx.mix(context)))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, _U, _U))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _none(name: str):
    return F.lit(None).cast("long").alias(name)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, id, text): ``doc`` stands for the id and the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.xxhash64(F.col(id_col), text).alias("doc"), F.col(id_col).alias("id"), text.alias("text"))


def _places(rows: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in tx.slices(batch, "text", CHUNK):
                data, at = tx.utf8(part.column(1))
                row, first, width, gram, context = anchors(data, at, length)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row)),
                        pa.array(first - at[row]),
                        pa.array(width.astype(np.int32)),
                        _signed(gram),
                        _signed(context),
                    ],
                    ["doc", "start", "width", "gram", "context"],
                )

    return rows.select("doc", "text").mapInArrow(run, "doc long, start long, width int, gram long, context long")


def _context_bytes(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(gram, context, bytes) of the wanted (gram, context, doc), by a second pass over the texts.

    Bitmaps of a fixed number of bits tell in the pass which documents hold a
    wanted context's first copy, and which of their contexts may be wanted.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((bitmap(wanted, "doc"), bitmap(wanted, "context")))

    def run(batches):
        docs, contexts = shared.value
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(docs, batch.column(0).to_numpy())))
            for part in tx.slices(batch, "text", CHUNK):
                data, at = tx.utf8(part.column(1))
                row, first, width, gram, context = anchors(data, at, length)
                use = np.flatnonzero(in_bitmap(contexts, context))
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(gram[use]),
                        _signed(context[use]),
                        part.column(0).take(pa.array(row[use])),
                        pa.array([raw[first[i] : first[i] + width[i] + length] for i in use.tolist()], pa.binary()),
                    ],
                    ["gram", "context", "doc", "bytes"],
                )

    got = rows.select("doc", "text").mapInArrow(run, "gram long, context long, doc long, bytes binary")
    key = ["gram", "context", "doc"]
    return got.join(wanted.select(*key), key, "left_semi").dropDuplicates(["gram", "context"]).drop("doc")


def maximal_repeats(contexts: list[bytes], length: int) -> list[Node]:
    """The tree of maximal repeats of at least ``length`` bytes, inner ones first.

    Each occurrence is listed once, at the longest repeat that it is one of, so
    the tree takes no more than the suffixes do. A context's first window counts as different to the left from all others,
    as what precedes it belongs to another context.
    """
    data = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.array([len(c) for c in contexts])
    base = np.cumsum(sizes) - sizes
    count = sizes - length + 1
    owner = np.repeat(np.arange(len(contexts)), count)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    place = base[owner] + offset
    h = rolling(data, (length,))[0][place]
    order = np.argsort(h, kind="stable")
    cut = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1]))
    size = np.diff(np.append(cut, len(order)))
    left = np.where(offset > 0, data[np.maximum(place - 1, 0)].astype(np.int64), 256 + owner)[order]
    diverse = np.minimum.reduceat(left, cut) != np.maximum.reduceat(left, cut)
    chosen = order[np.repeat((size > 1) & diverse, size)]
    if not len(chosen):
        return []
    # The suffix array of the chosen suffixes, each up to the end of its context.
    suffixes = sorted(
        (contexts[c][o:], int(c), int(o)) for c, o in zip(owner[chosen].tolist(), offset[chosen].tolist(), strict=True)
    )
    nodes: list[Node] = []
    stack = [_Interval(0, None, [], [])]
    for i, (text, c, o) in enumerate(suffixes):
        shared = _common(text, suffixes[i + 1][0]) if i + 1 < len(suffixes) else 0
        shared = shared if shared >= length else 0
        inner = _Interval(len(text), contexts[c][o - 1] if o else 256 + c, [i], [])
        while stack[-1].size > shared:
            stack[-1].take(inner)
            inner = stack.pop()
            if inner.left is DIVERSE:
                _, c, o = suffixes[i]
                nodes.append(Node(inner.size, (c, o), [suffixes[k][1:] for k in inner.own], None))
                for child in inner.nodes:
                    nodes[child].parent = len(nodes) - 1
                inner.own, inner.nodes = [], [len(nodes) - 1]
        if stack[-1].size < shared:
            stack.append(_Interval(shared, inner.left, inner.own, inner.nodes))
        else:
            stack[-1].take(inner)
    return nodes


DIVERSE = object()


@dataclass
class Node:
    """A maximal repeat: ``size`` bytes from ``example``. ``own`` are the occurrences that lie in no
    longer one; the others are those of the nodes whose ``parent`` this is."""

    size: int
    example: tuple[int, int]
    own: list[tuple[int, int]]
    parent: int | None


@dataclass
class _Interval:
    """An open interval of the scan; ``left`` is its members' only byte to the left, or DIVERSE."""

    size: int
    left: object
    own: list[int]
    nodes: list[int]

    def take(self, inner: "_Interval") -> None:
        if self.left is None or self.left == inner.left:
            self.left = inner.left
        else:
            self.left = DIVERSE
        self.own += inner.own
        self.nodes += inner.nodes


def _name(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big", signed=True)


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int((x != y).argmax())


def _searched(contexts: DataFrame, length: int, total: int) -> DataFrame:
    """(gram, context, start, size, repeat, inside): occurrences of maximal repeats in contexts that differ.

    Each stands once, at its longest repeat; the occurrences of a repeat are its
    own and those of the repeats that name it as ``inside``. A repeat that has
    none of its own gets a row without a context."""
    dealt = contexts.repartition(parts(total, 10_000), "gram").sortWithinPartitions("gram", "context")

    def run(batches):
        grams, keys, texts, held = [], [], [], 0

        def flush():
            rows = []
            lo = 0
            while lo < len(grams):
                hi = lo
                while hi < len(grams) and grams[hi] == grams[lo]:
                    hi += 1
                group = texts[lo:hi]
                nodes = maximal_repeats(group, length) if hi > lo + 1 else []
                names = [_name(group[x.example[0]][x.example[1] :][: x.size]) for x in nodes]
                for node, name in zip(nodes, names, strict=True):
                    inside = None if node.parent is None else names[node.parent]
                    rows += [(grams[lo], keys[lo + c], o, node.size, name, inside) for c, o in node.own]
                    if not node.own:  # the repeat itself, without an occurrence of its own
                        rows.append((grams[lo], None, None, node.size, name, inside))
                lo = hi
            columns = list(zip(*rows, strict=True)) or [()] * 6
            names = ["gram", "context", "start", "size", "repeat", "inside"]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in batches:
            for gram, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held > TASK_BYTES and gram != grams[-1]:
                    yield flush()
                    grams, keys, texts, held = [], [], [], 0
                grams.append(gram)
                keys.append(key)
                texts.append(text)
                held += len(text)
        if grams:
            yield flush()

    schema = "gram long, context long, start long, size long, repeat long, inside long"
    return dealt.select("gram", "context", "bytes").mapInArrow(run, schema)


def _counted(contexts: DataFrame, length: int) -> DataFrame:
    """The same for grams of very many contexts: windows that repeat, by an aggregate of their hashes."""

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                h = rolling(np.frombuffer(batch.column(2)[r].as_buffer(), np.uint8), (length,))[0]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([r] * len(h))),
                        batch.column(1).take(pa.array([r] * len(h))),
                        pa.array(np.arange(len(h))),
                        _signed(h),
                    ],
                    ["gram", "context", "start", "repeat"],
                )

    windows = contexts.select("gram", "context", "bytes").mapInArrow(run, "gram long, context long, start long, repeat long")
    often = windows.groupBy("repeat").agg(F.count("*").alias("n")).filter("n > 1").select("repeat")
    found = windows.join(often, "repeat")
    return found.select("gram", "context", "start", F.lit(length).cast("long").alias("size"), "repeat", _none("inside"))


def repeat_occurrences(rows: DataFrame, *, length: int = 200, many: int = 8192) -> DataFrame:
    """(doc, start, size, repeat, inside) of repeats, from rows (doc, text), in bytes.

    Every occurrence stands once, at its longest repeat (``_searched``); rows
    without a document are repeats whose occurrences all lie in longer ones."""
    places = stored(_places(rows, length), "anchors")
    contexts = places.groupBy("gram", "context").agg(
        F.count("*").alias("n"), F.max("width").alias("width"), F.min("doc").alias("doc")
    )
    contexts = stored(contexts, "contexts")
    grams = contexts.groupBy("gram").agg(F.count("*").alias("k"), F.min("n").alias("least"))
    grams = grams.filter("k > 1 and least = 1").select("gram", "k")
    wanted = stored(contexts.join(grams, "gram").select("gram", "context", "k", "doc"), "differing-contexts")
    differing = stored(_context_bytes(rows, wanted, length).join(grams, "gram"), "context-bytes")
    sizes = wanted.agg(F.count("*").alias("n"), F.max("k").alias("k")).first()
    inside = _searched(differing.filter(F.col("k") <= many), length, sizes["n"])
    if (sizes["k"] or 0) > many:
        inside = inside.union(_counted(differing.filter(F.col("k") > many), length))
    equal = contexts.filter("n > 1").select(
        "gram", "context", F.lit(0).cast("long").alias("start"), (F.col("width") + length).cast("long").alias("size"),
        F.col("context").alias("repeat"), _none("inside"),
    )
    found = stored(inside.union(equal), "repeats")
    outer = found.filter("context is null").select(_none("doc"), "start", "size", "repeat", "inside")
    places = places.select("doc", "gram", "context", F.col("start").alias("at"))
    occurring = places.join(found, ["gram", "context"]).withColumn("start", F.col("at") + F.col("start"))
    return occurring.select(*outer.columns).union(outer)


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by the ranges."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.append(True, starts[1:] > ends[:-1]))
    return list(zip(starts[new].tolist(), ends[np.append(new[1:], len(ends)) - 1].tolist(), strict=True))


def removed(
    docs: DataFrame, *, id_col="doc_id", text_col="text", length: int = 200, many: int = 8192, kept: bool = True
) -> DataFrame:
    """Per row: id, ``n_bytes``, ``spans`` (maximal runs of bytes that go, [start, end)), ``kept_sha256``
    and, if asked for, ``kept`` (the other bytes)."""
    rows = _keyed(docs, id_col, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    runs = repeat_occurrences(rows.select("doc", "text"), length=length, many=many).filter("doc is not null")
    # A range as one number: the start, then 16 bits of the size, which a context bounds.
    runs = runs.groupBy("doc").agg(F.collect_list(F.shiftleft("start", 16) + F.col("size")).alias("runs"))

    def run(batches):
        kind = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            data, at = tx.utf8(batch.column(1))
            raw, at = data.tobytes(), at.tolist()
            lists = batch.column(2)
            spans, left, digests = [], [], []
            for r in range(batch.num_rows):
                text, own = raw[at[r] : at[r + 1]], []
                if lists[r].is_valid:
                    packed = lists[r].values.to_numpy()
                    own = _merged(packed >> 16, (packed >> 16) + (packed & 0xFFFF))
                    edges = [0, *(x for span in own for x in span), len(text)]
                    text = b"".join(text[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
                spans.append([{"start": a, "end": b} for a, b in own])
                digests.append(hashlib.sha256(text).hexdigest())
                left.append(text if kept else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([b - a for a, b in zip(at[:-1], at[1:], strict=True)], pa.int64()),
                    pa.array(spans, pa.list_(kind)),
                    pa.array(digests, pa.string()),
                    pa.array(left, pa.binary()),
                ],
                [id_col, "n_bytes", "spans", "kept_sha256", "kept"],
            )

    spans = "spans array<struct<start:long,`end`:long>>"
    schema = f"`{id_col}` {id_type}, n_bytes long, {spans}, kept_sha256 string, kept binary"
    found = rows.join(runs, "doc", "left").select("id", "text", "runs").mapInArrow(run, schema)
    return found if kept else found.drop("kept")
