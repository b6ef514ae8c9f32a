"""Merkle manifest of a dataset (operator 13): slot pivots.

Each row is a leaf: a SHA-256 digest of its fields. Within a group the leaves
stand in order, and a conditional aggregate a slot spreads the children of each
parent (``FANOUT`` consecutive nodes) into the columns ``c0``, ``c1``, ... of
one row. The digest of the concatenated columns is the parent's; the columns
without a child's own are its siblings. Parents are pivoted in the same way, until a
group is down to one node, its subroot; the subroots, in order of their group, are
the leaves of the tree above, which ends in the root.

Proofs come from the top down: a parent hands its path to the root to its
children, each with its own siblings put before it. So no step joins on a
group: rows meet by (group, place), and a group that holds a third of
all rows is spread like any other. Places come from a range sort
(``operators.ordering``). Each level is a written table, an eighth the size of
the one below; a tree of n leaves takes log8(n) of them.

Defined results: null fields are hashed as ``-``, others as their length in
UTF-8 bytes, a colon and their text, so no two rows of different fields
share their input; a null group is a group, the first; null ids come first; rows that
repeat an id stand in the order of their digests, and rows equal in all are leaves
of their own; an empty table has no leaf and no root. Columns not named are
neither hashed nor kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countlens.llm.common import stored
from countlens.operators.ordering import placed

FANOUT = 8


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row's fields, as lowercase hex."""

    def one(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[one(f) for f in fields]), 256)


def proof_digest(path: Column) -> Column:
    """Digest of a proof: all its siblings, from the leaf's level up, left to right."""
    return F.sha2(F.concat_ws("", F.flatten(F.transform(path, lambda x: F.array(x["left"], x["right"])))), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda digest, x: F.sha2(F.concat(x["left"], digest, x["right"]), 256))


@dataclass(frozen=True)
class Tree:
    """Leaves (``grp``, ``at``, ``n``, ``digest`` and what was carried along) and the levels above.

    A level has a row per parent: ``grp``, its place ``at`` among the group's ``n`` of
    that level, its children ``c0``... and its ``digest``.
    """

    leaves: DataFrame
    levels: list[DataFrame]

    def subroots(self) -> DataFrame:
        """(``grp``, ``digest``) of the one node that is left of each group."""
        out = None
        for level in [self.leaves, *self.levels]:
            part = level.filter("n = 1").select("grp", "digest")
            out = part if out is None else out.union(part)
        return out


def grow(leaves: DataFrame, fanout: int = FANOUT) -> Tree:
    """The tree over leaves that have ``grp`` (not null), ``at``, ``n`` and ``digest``."""
    levels, nodes = [], leaves
    height = 0
    largest = leaves.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        height += 1
        slot = F.pmod("at", F.lit(fanout))
        # The lowest level's columns hold the whole child, so that its rows need not be joined again.
        child = F.struct(*[c for c in nodes.columns if c not in ("grp", "at", "n")]) if height == 1 else F.struct("digest")
        spread = [F.max(F.when(slot == i, child)).alias(f"c{i}") for i in range(fanout)]
        pivot = nodes.filter("n > 1").groupBy("grp", F.floor(F.col("at") / fanout).alias("at")).agg(F.max("n").alias("n"), *spread)
        digest = F.sha2(F.concat_ws("", *[F.col(f"c{i}.digest") for i in range(fanout)]), 256)
        level = pivot.withColumn("n", F.ceil(F.col("n") / fanout)).withColumn("digest", digest)
        nodes = stored(level, f"merkle-level{height}")
        levels.append(nodes)
        largest = -(-largest // fanout)
    return Tree(leaves, levels)


def _children(parents: DataFrame, fanout: int) -> DataFrame:
    """Each child of ``parents`` with the siblings beside it put before its parent's path."""

    def beside(slots: range) -> Column:
        return F.concat_ws("", *[F.col(f"c{i}.digest") for i in slots])

    rows = [
        F.struct(
            F.col(f"c{i}").alias("child"),
            (F.col("at") * fanout + i).alias("child_at"),
            F.struct(beside(range(i)).alias("left"), beside(range(i + 1, fanout)).alias("right")).alias("beside"),
        )
        for i in range(fanout)
    ]
    spread = parents.select("grp", "path", "subroot", "root", F.inline(F.array(*rows))).filter("child is not null")
    path = F.concat(F.array("beside"), F.col("path"))
    return spread.select("grp", F.col("child_at").alias("at"), path.alias("path"), "subroot", "root", "child")


def descend(tree: Tree, tops: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Each leaf with ``path``, ``subroot`` and ``root``, from ``tops``: (``grp``, ``path``, ``subroot``,
    ``root``) of each group's subroot."""
    carried = [c for c in tree.leaves.columns if c not in ("at", "n")]
    tops = tops.select("grp", "path", "subroot", "root")
    above = inner = None
    for height in range(len(tree.levels) - 1, -1, -1):
        level = tree.levels[height]
        met = level.filter("n = 1").join(tops, "grp")  # groups whose topmost node is here, one row each
        if above is not None:
            met = met.unionByName(level.filter("n > 1").join(above, ["grp", "at"]))
        children = _children(met, fanout)
        if height:
            above = stored(children.drop("child"), "merkle-paths")
        else:
            inner = children.select("grp", "path", "subroot", "root", "child.*")
    lone = tree.leaves.filter("n = 1").join(tops, "grp").select(*carried, "path", "subroot", "root")
    return lone if inner is None else inner.select(*lone.columns).unionByName(lone)


def manifest(
    docs: DataFrame,
    *,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "lang",
    fanout: int = FANOUT,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per document: its id, group, ``leaf``, ``subroot``, ``root`` and ``path``, an array a
    level of (``left``, ``right``): the hex digests of its siblings there. ``carry`` adds
    columns, computed from the document."""
    extra = {f"carried_{i}": c for i, c in enumerate((carry or {}).values())}
    leaves = docs.select(
        # Bytewise order of groups, with the null group first.
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("grp"),
        F.col(id_col).alias("id"),
        leaf_digest([F.col(c) for c in fields]).alias("digest"),
        F.col(group_col).alias("group"),
        *[c.alias(name) for name, c in extra.items()],
    )
    leaves = stored(leaves, "merkle-digests")
    ordered = placed(leaves, ["grp"], [F.col("id").asc_nulls_first(), F.col("digest")], "at", "n")
    tree = grow(stored(ordered, "merkle-leaves"), fanout)
    groups = placed(stored(tree.subroots(), "merkle-subroots").withColumn("one", F.lit("")), ["one"], [F.col("grp")], "at", "n")
    crown = stored(groups.select(F.lit("").alias("grp"), "at", "n", "digest", F.col("grp").alias("below")), "merkle-crown")
    top = grow(crown, fanout)
    root = top.subroots().select("grp", F.array().cast("array<struct<left:string,right:string>>").alias("path"),
                                 F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    tops = descend(top, root, fanout)
    tops = stored(tops.select(F.col("below").alias("grp"), "path", F.col("digest").alias("subroot"), "root"), "merkle-tops")
    found = descend(tree, tops, fanout)
    names = dict(zip(extra, carry or {}, strict=True))
    return found.select(
        F.col("id").alias(id_col),
        F.col("group").alias(group_col),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "path",
        *[F.col(c).alias(name) for c, name in names.items()],
    )


#: What ``translate`` folds.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tampered_leaf(fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text")) -> Column:
    """The leaf of a document whose text is tampered with: A-Z become lower case where 3 divides
    the checksum of its id, and nothing changes elsewhere, or where the id is null."""
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    text = F.when(chosen, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    return leaf_digest([text if c == "text" else F.col(c) for c in fields])
