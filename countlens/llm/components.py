"""Connected components of an edge table.

Edges are first contracted in blocks of a bounded number: a task unites its
block's edges and puts out a star for each of its components. If there is more
than one block, alternating star rounds follow, each over blocks contracted
again: every node's larger neighbours are linked to its smallest neighbour
(large star), then its smaller neighbours to the smallest of them (small star),
until nothing changes, after about log(n) rounds. Neighbourhoods are never
gathered: a round takes aggregates of minima, combined before the shuffle, and
joins whose skewed keys Spark may split. Each round's edges are written to the
shared folder, so lineage stays short.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countlens.llm.common import parts, stored

BLOCK_EDGES = 100_000


def find(parent: dict, x):
    """The root of x in a union-find of a dict, which gains x."""
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``component``) of each node with an edge, from edges (``x``, ``y``); the component
    is its smallest node. Self-loops and repeated edges change nothing; null nodes are left out."""
    edges = stored(edges.filter("x <> y").select("x", "y"), "edges")
    blocks = parts(edges.count(), BLOCK_EDGES)
    edges = stored(_contracted(edges, blocks), "edges")
    before = None
    while blocks > 1:  # a contraction in one block unites all there is
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("x", "y")).alias("h")).first()
        if state == before:
            break
        before = state
        blocks = parts(state["n"], BLOCK_EDGES)
        edges = stored(_contracted(_small_star(_large_star(edges)), blocks).distinct(), "edges")
    roots = edges.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct()
    return edges.select(F.col("x").alias("node"), F.col("y").alias("component")).union(roots)


def _contracted(edges: DataFrame, blocks: int) -> DataFrame:
    """The edges as stars (node, smallest node it is connected with in its block), without the
    roots' loops, so that states compare whatever the number of blocks."""

    def run(batches):
        parent: dict[int, int] = {}
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = find(parent, x), find(parent, y)
                parent[max(x, y)] = min(x, y)
        nodes = list(parent)
        roots = [find(parent, x) for x in nodes]
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], ["x", "y"])

    stars = edges.select("x", "y").coalesce(blocks).mapInArrow(run, "x long, y long")
    return stars.filter("x <> y")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("y", "x"))
    low = both.groupBy("x").agg(F.min("y").alias("low")).select("x", F.least("x", "low").alias("low"))
    return both.join(low, "x").filter("y > x").select(F.col("y").alias("x"), F.col("low").alias("y"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("x").agg(F.min("y").alias("low"))
    down = edges.join(low, "x").filter("y <> low").select(F.col("y").alias("x"), F.col("low").alias("y"))
    return down.union(low.select("x", F.col("low").alias("y")))
