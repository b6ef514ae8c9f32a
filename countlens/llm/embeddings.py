"""Embedding near-dedup (operator 1): sorted projection passes.

Equal vectors are one node, with a count. In each pass every node gets
concatenated random hashes (signs of its products with random directions) and
the nodes are ordered by them; a node is compared with the next ``window`` nodes
of the order, in double precision. The order is a range sort of small rows;
ranks follow from the sizes of its partitions, and blocks of consecutive ranks,
each with the first nodes of the next block, are compared in tasks. Links from
all passes are united into components; within a block only links that connect
something new are put out.

Where vectors are dense (a topic's cone), more nodes than a window share the
leading hashes that a pass counts on. All pairs of such a crowded bucket are
compared, in blocks: a search from node to node that leaves out what it has
reached, so near copies cost little, and unlike nodes of one bucket the square
of their number. So any two nodes that agree in a pass's leading hashes are
compared in it, however the vectors are spread; the number of passes follows
from the number of nodes, and a pair at the threshold is compared with
probability ``recall`` or more, at any size and density.

The windows bound what is compared, not what is counted: all pairs within a
component are then compared in blocks of bounded size, and each node's links
are counted exactly; only the counts leave the tasks. That work grows with the
square of a component, as the number of links does.

Defined results: vectors that are null, empty or zero, or hold null or
non-finite components, link with nothing, nor do vectors of different length;
rows that repeat an id are separate vectors; a null id takes part, is never
kept, and its component is the smallest id that is not null. Other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countlens.llm.common import parts, stored
from countlens.llm.components import components, find

WINDOW = 64
BLOCK = 2048
PASSES_A_JOB = 8


def bits_for(n: int, window: int = WINDOW) -> float:
    """Leading hashes that narrow evenly spread nodes down to a quarter of a window."""
    return max(1.0, math.log2(max(n, 2) / window) + 2)


def passes_for(n: int, threshold: float, recall: float, window: int = WINDOW) -> int:
    """Passes in which a pair at the threshold agrees, at least once, in the leading hashes."""
    agree = 1 - math.acos(threshold) / math.pi
    return max(4, math.ceil(math.log(1 - recall) / math.log(1 - agree ** bits_for(n, window))))


def directions(number: int, dim: int) -> np.ndarray:
    return np.random.default_rng((7919, number, dim)).standard_normal((dim, 64))


def _nodes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(node, rep, n, vector) of the distinct usable vectors."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.withColumn("node", F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("vector")))
    return rows


def unit(batch_column) -> list[np.ndarray]:
    """Vectors of a list column, scaled to length 1."""
    out = []
    for v in batch_column:
        x = np.array(v.values.to_numpy(zero_copy_only=False), np.float64)
        x = x / np.abs(x).max()
        out.append(x / math.sqrt(float(x @ x)))
    return out


def _keys(nodes: DataFrame, numbers: range) -> DataFrame:
    def run(batches):
        known: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            by_dim: dict[int, list[int]] = {}
            units = unit(batch.column(1))
            for i, x in enumerate(units):
                by_dim.setdefault(len(x), []).append(i)
            for dim, rows in by_dim.items():
                x = np.stack([units[i] for i in rows])
                for number in numbers:
                    if (number, dim) not in known:
                        known[number, dim] = directions(number, dim)
                    signs = (x @ known[number, dim]) > 0
                    key = np.packbits(signs, axis=1).view(">i8").ravel().astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(rows), number, np.int32)),
                            pa.array(np.full(len(rows), dim, np.int32)),
                            pa.array(key),
                            batch.column(0).take(pa.array(rows)),
                        ],
                        ["number", "dim", "key", "node"],
                    )

    return nodes.select("node", "vector").mapInArrow(run, "number int, dim int, key long, node long")


def _pass_links(nodes: DataFrame, n: int, numbers: range, threshold: float, window: int) -> DataFrame:
    """Links found by some passes that connect something within their block."""
    order = ["number", "dim", "key", "node"]
    rows = n * len(numbers)
    ordered = _keys(nodes, numbers).repartitionByRange(parts(rows, 200_000), *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    ordered = ordered.withColumn("part", F.shiftright(place, 33)).withColumn("at", place.bitwiseAND(F.lit((1 << 33) - 1)))
    ordered = stored(ordered, "embedding-order")
    # One row per partition of the sort.
    sizes = ordered.groupBy("part").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = ordered.join(F.broadcast(sizes), "part").withColumn("rank", F.col("before") + F.col("at"))
    block = F.floor(F.col("rank") / BLOCK)
    also = F.when((F.col("rank") % BLOCK < window) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))
    within = _crowded_links(ordered, nodes, int(bits_for(n, window)), threshold, window)
    placed = ranked.select("number", "dim", "node", "rank", F.explode(also).alias("block"))
    placed = placed.join(nodes.select("node", "vector"), "node").select("block", "rank", "number", "dim", "node", "vector")
    placed = placed.repartition(parts(rows, 8 * BLOCK), "block").sortWithinPartitions("block", "rank")

    def compare(block, rank, number, dim, node, vector):
        own = rank < (block + 1) * BLOCK
        parent: dict[int, int] = {}
        links = []
        for lo in range(0, len(rank)):
            if lo and (number[lo], dim[lo]) == (number[lo - 1], dim[lo - 1]):
                continue
            hi = lo
            while hi < len(rank) and (number[hi], dim[hi]) == (number[lo], dim[lo]):
                hi += 1
            x = np.stack(vector[lo:hi])
            for o in range(1, min(window, hi - lo - 1) + 1):
                near = np.flatnonzero((np.einsum("ij,ij->i", x[:-o], x[o:]) >= threshold) & own[lo : hi - o])
                for i in near.tolist():
                    a, b = node[lo + i], node[lo + i + o]
                    ra, rb = find(parent, a), find(parent, b)
                    if ra != rb:
                        parent[ra] = rb
                        links.append((min(a, b), max(a, b)))
        return links

    def run(batches):
        held, rows = None, []

        def flush():
            if rows:
                rank, number, dim, node, vector = zip(*rows, strict=True)
                links = compare(held, np.array(rank), number, dim, node, vector)
                if links:
                    x, y = zip(*links, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["x", "y"])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for block, *row in zip(*columns, unit(batch.column(5)), strict=True):
                if block != held:
                    yield from flush()
                    held, rows = block, []
                rows.append(row)
        yield from flush()

    return placed.mapInArrow(run, "x long, y long").union(within)


def _dealt(members: DataFrame, group: list[str], nodes: DataFrame, columns: list[str], tasks: int) -> DataFrame:
    """Members of groups of size ``f``, in blocks that meet each other: rows of a pair (i, j) of
    a group's blocks, together in a task."""
    members = members.withColumn("blocks", F.ceil(F.col("f") / F.lit(BLOCK)).cast("int"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    members = members.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select(*group, F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node")
    members = members.join(nodes.select("node", "n", "vector"), "node").select(*group, "i", "j", *columns)
    dealt = members.repartition(tasks, *group, "i", "j") if tasks else members.repartition(*group, "i", "j")
    return dealt.sortWithinPartitions(*group, "i", "j")


def forest(x: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links that connect all rows of ``x`` that links connect, by searches over the rows not yet reached."""
    links, left = [], np.arange(len(x))
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            own, front = front[:64], front[64:]
            near = x[own] @ x[left].T >= threshold
            new = near.any(axis=0)
            links += zip(own[near.argmax(axis=0)[new]].tolist(), left[new].tolist(), strict=True)
            front, left = np.concatenate([front, left[new]]), left[~new]
    return links


def _crowded_links(ordered: DataFrame, nodes: DataFrame, bits: int, threshold: float, window: int) -> DataFrame:
    """Links among the nodes that share a pass's leading ``bits`` hashes with more than a window
    of others; fewer lie within a window in the order."""
    bucket = ["number", "dim", "bucket"]
    rows = ordered.select("number", "dim", F.shiftright("key", 64 - min(bits, 64)).alias("bucket"), "node")
    crowded = rows.groupBy(*bucket).agg(F.count("*").alias("f")).filter(F.col("f") > window + 1)
    dealt = _dealt(rows.join(crowded, bucket), bucket, nodes, ["node", "vector"], 0)

    def run(batches):
        held, rows = None, []

        def flush():
            if rows:
                node, vector = zip(*rows, strict=True)
                links = [(node[a], node[b]) for a, b in forest(np.stack(vector), threshold)]
                x, y = [min(p) for p in links], [max(p) for p in links]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["x", "y"])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for *group, node, vector in zip(*columns, unit(batch.column(6)), strict=True):
                if group != held:
                    yield from flush()
                    held, rows = group, []
                rows.append((node, vector))
        yield from flush()

    return dealt.mapInArrow(run, "x long, y long")


def _counts(nodes: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """(node, links): vectors at other nodes that each node links with, within its component."""
    size = classes.groupBy("component").agg(F.count("*").alias("f"))
    columns = ["mine", "node", "n", "vector"]
    dealt = _dealt(classes.join(size, "component"), ["component"], nodes, columns, parts(classes.count(), 4 * BLOCK))

    def run(batches):
        held, rows = None, []

        def flush():
            if not rows:
                return
            mine, node, n, vector = zip(*rows, strict=True)
            x, n, mine = np.stack(vector), np.array(n, np.int64), np.array(mine)
            links = np.zeros(len(x), np.int64)
            for lo in range(0, len(x), 512):
                near = x[lo : lo + 512] @ x.T >= threshold
                here = np.arange(lo, min(lo + 512, len(x)))
                near[here - lo, here] = False
                if held[1] != held[2]:
                    near &= mine[here][:, None] != mine[None, :]
                links[here] = near @ n
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(links)], ["node", "links"])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for *group, mine, node, n, vector in zip(*columns, unit(batch.column(6)), strict=True):
                if group != held:
                    yield from flush()
                    held, rows = group, []
                rows.append((mine, node, n, vector))
        yield from flush()

    return dealt.mapInArrow(run, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicates(
    vectors: DataFrame,
    *,
    id_col="vec_id",
    vector_col="embedding",
    threshold: float = 0.95,
    recall: float = 0.999,
    window: int = WINDOW,
) -> DataFrame:
    """Per vector: id, ``n_links``, ``component_id`` and ``kept``."""
    rows = _nodes(vectors, id_col, vector_col)
    nodes = rows.filter("node is not null").groupBy("node")
    nodes = stored(nodes.agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.first("vector").alias("vector")), "embedding-nodes")
    n = nodes.count()
    total, links = passes_for(n, threshold, recall, window), None
    for first in range(0, total, PASSES_A_JOB):
        found = _pass_links(nodes, n, range(first, min(total, first + PASSES_A_JOB)), threshold, window)
        found = stored(found, "embedding-links")
        links = found if links is None else links.union(found)
    classes = stored(components(links), "embedding-classes")
    counts = _counts(nodes, classes, threshold)
    least = classes.join(nodes, "node").groupBy("component").agg(F.min("rep").alias("least"))
    named = classes.join(least, "component").select("node", "least")
    known = nodes.select("node", "rep", "n").join(named, "node", "left").join(counts, "node", "left")
    known = known.select(
        "node", F.coalesce("least", "rep").alias("least"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links")
    )
    out = rows.select("id", "node").join(known, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
