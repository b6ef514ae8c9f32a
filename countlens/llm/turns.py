"""Prefix trie of conversations (operator 12): burst tries.

A conversation is a sequence of turns, each known by a digest of its role and
text. Conversations are cut into segments of ``SEGMENT`` turns, so no row grows
with a conversation; a segment's trie stands under the *head* that the turns
before it lead to (a chained digest). Equal segments under a head are one row
with a count before anything else, however many conversations share them.

Rows under a head are a container of suffixes. A container of more than ``BOX``
turns bursts: its rows' common prefix becomes a chain of nodes, and the rows
go to a container for each next turn. Every burst splits, so a container of any
size is soon dealt out, and a first turn that a third of all rows share is one
container for one round only. Containers that remain are sorted by Spark and
swept in tasks, each into its nodes, with at most ``BOX`` turns in memory.

Sums over subtrees flow up: from the deepest segments to the first, and from a burst
container's children to its chain. A conversation that is alone under its head
is a chain to its end and is written turn by turn, without any container.

Rounds: one a burst depth, and one a ``SEGMENT`` turns of the longest prefix
that several conversations share. A node's list of ended conversations is
hashed from sorted chunks by a running digest, a chunk at a time: SHA-256 has no
other way, so the chunks of one node meet in one task, though never in memory.

Defined results: turns go by their number (null first), equal numbers by the first
16 characters of role and text, then by digest, so ties and repeated rows have a fixed
place; null roles and texts are empty; rows without
a conversation id are left out; an empty table has no node, not even a root.
Columns not named are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countlens.llm.common import importable, parts, stored
from countlens.operators.ordering import placed

SEGMENT = 256
BOX = 1 << 16
EMPTY = hashlib.sha256(b"").hexdigest()

_SUMS = "n_leaves long, saved long, n_children long"
_ROWS = "box binary, base long, up long, rest array<binary>, lens array<long>, n long, low long, key binary, below_leaves long, below_saved long, below_children long"
_NODES = "box binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, key binary"


def numbered(turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """(``conv``, ``at``, ``own``, ``tid``, ``len``): each turn's place in its conversation, the
    conversation's turns, the turn's digest and the code points of its text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.substring(role, 1, 16).alias("r"),
        F.substring(text, 1, 16).alias("t"),
        F.unhex(F.md5(said)).alias("tid"),
        F.length(text).cast("long").alias("len"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("r"), F.col("t"), F.col("tid")]
    return placed(stored(rows, "turns"), ["conv"], order, "at", "own").select("conv", "at", "own", "tid", "len")


def rebuilt(turns: DataFrame, head: Column | None = None, base: Column | None = None, most: int = 5) -> DataFrame:
    """Conversations that begin with the first turns of another one: (``conv``, ``at``, ``total``, ``tid``, ``len``).

    ``head``: turns taken from conversation ``base`` (both functions of ``conv``, at most ``most``), which stand
    for the conversation's own first ones. A conversation of no turns has one row, with a null place.
    """
    own = stored(turns, "turns-own")
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % 6 if head is None else head
    base = F.col("conv") - F.col("conv") % 100 if base is None else base
    convs = own.filter("at = 0").select("conv", "own", head.alias("h"), base.alias("base"))
    first = F.sort_array(F.collect_list(F.struct("at", "tid", "len")))  # of at most ``most`` rows
    heads = own.filter(F.col("at") < most).join(convs.select(F.col("base").alias("conv")).distinct(), "conv", "left_semi").groupBy(F.col("conv").alias("base")).agg(first.alias("first"))
    plans = convs.join(heads, "base", "left").select(
        "conv", "own", "h", F.slice(F.coalesce("first", F.array().cast("array<struct<at:long,tid:binary,len:long>>")), F.lit(1), F.col("h").cast("int")).alias("taken")
    )
    plans = plans.withColumn("total", F.size("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    plans = stored(plans, "turns-plans")
    taken = plans.select("conv", "total", F.inline_outer("taken")).select("conv", "at", "total", "tid", "len")
    kept = plans.select("conv", "h", F.size("taken").alias("shift"), "total")
    # A conversation's turns lie in (conv, block) rows of bounded number, so a long one is no hot key.
    block = F.floor(F.col("at") / SEGMENT)
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("own") - 1) / SEGMENT).cast("long")))
    spread = plans.select("conv", "h", F.size("taken").alias("shift"), "total", blocks.alias("block"))
    rest = own.withColumn("block", block).join(spread, ["conv", "block"]).filter("at >= h")
    rest = rest.select("conv", (F.col("at") - F.col("h") + F.col("shift")).alias("at"), "total", "tid", "len")
    empty = F.col("at").isNull() & (F.col("total") > 0)  # nothing taken, but own turns
    return taken.filter(~empty).unionByName(rest)


def trie(turns: DataFrame, segment: int = SEGMENT, box: int = BOX) -> DataFrame:
    """The trie's nodes, from (``conv``, ``at``, ``total``, ``tid``, ``len``) as ``rebuilt`` gives them:
    ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``."""
    spark = turns.sparkSession
    importable(spark)
    turns = stored(turns, "turns-rebuilt")
    cut = turns.filter("at is not null").groupBy("conv", F.floor(F.col("at") / segment).alias("seg"), "total")
    said = F.sort_array(F.collect_list(F.struct("at", "tid", "len")))  # at most ``segment`` rows
    cut = cut.agg(said.alias("said")).select(
        "conv", "seg", "total", F.transform("said", lambda x: x["tid"]).alias("rest"), F.transform("said", lambda x: x["len"]).alias("lens")
    )
    segments = stored(cut, "turns-segments")
    convs = turns.filter("at is null or at = 0").select("conv", "total").distinct()
    root = convs.agg(F.min("conv").alias("low"), F.count("*").alias("n"), F.max("total").alias("longest")).first()
    if not root["n"]:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")

    # Forward: the head of each conversation's segments, for as long as several conversations share one.
    key = F.unhex(F.md5(F.concat(F.col("head"), F.array_join(F.transform("rest", F.hex), "").cast("binary"))))
    nothing = F.lit(b"")
    alive = segments.filter("seg = 0").select("conv", "total", nothing.alias("head"), F.lit(root["low"]).alias("up"), "rest", "lens")
    rounds, ends, lone = [], convs.filter("total = 0").select("conv", nothing.alias("key")), None
    deep = 0
    while True:
        alive = stored(alive.withColumn("key", key), "turns-alive")
        rounds.append(alive)
        deep += 1
        ends = ends.unionByName(alive.filter(F.col("total") <= deep * segment).select("conv", "key"))
        if root["longest"] <= deep * segment:
            break
        on = alive.filter(F.col("total") > deep * segment).select("conv", "key")
        lows = alive.groupBy("key").agg(F.min("conv").alias("up"), F.count(F.when(F.col("total") > deep * segment, 1)).alias("go"))
        heads = stored(on.join(lows, "key").select("conv", F.col("key").alias("head"), "up", "go"), "turns-heads")
        single = heads.filter("go = 1").withColumn("start", F.lit(deep * segment).cast("long"))
        lone = single if lone is None else lone.unionByName(single)
        ends = ends.unionByName(single.select("conv", _alone(F.col("conv")).alias("key")))
        shared = heads.filter("go > 1").drop("go")
        if shared.isEmpty():
            break
        alive = segments.filter(F.col("seg") == deep).join(shared, "conv").select("conv", "total", "head", "up", "rest", "lens")

    # Backward: each segment's tries, with what flows up from the next.
    nodes: list[DataFrame] = []
    sums = alone = None
    if lone is not None:
        lone = stored(lone, "turns-lone")
        nodes.append(stored(_chains(turns, lone), "turns-chains"))
        alone = lone.select("head", F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved"), F.lit(1).cast("long").alias("n_children"))
    for number in range(len(rounds) - 1, -1, -1):
        rows = rounds[number].groupBy(F.col("head").alias("box"), "up", "rest", "lens", "key").agg(
            F.count("*").alias("n"), F.min("conv").alias("low")
        )
        rows = rows.withColumn("base", F.lit(number * segment).cast("long"))
        if alone is not None:
            sums = alone if sums is None else sums.unionByName(alone)
        if sums is None:
            rows = rows.select("*", *[F.lit(0).cast("long").alias(f"below_{c}") for c in ("leaves", "saved", "children")])
        else:
            under = sums.select(F.col("head").alias("key"), *[F.col(a).alias(b) for a, b in (("n_leaves", "below_leaves"), ("saved", "below_saved"), ("n_children", "below_children"))])
            rows = rows.join(under, "key", "left").fillna(0, ["below_leaves", "below_saved", "below_children"])
        made, sums = _grow(rows, box)
        nodes += made
    body = nodes[0]
    for part in nodes[1:]:
        body = body.unionByName(part)
    kids, leaves, saved = (sums.filter(F.col("head") == nothing).select("n_children", "n_leaves", "saved").first() or (0, 1, 0)) if sums is not None else (0, 1, 0)
    long = lambda x: F.lit(x).cast("long")
    top = spark.range(1).select(
        nothing.alias("box"), long(root["low"]).alias("conv_id"), long(0).alias("depth"), long(None).alias("parent_conv_id"),
        long(root["n"]).alias("n_convs"), long(kids).alias("n_children"), long(leaves).alias("n_leaves"),
        long(saved).alias("saved_tokens"), nothing.alias("key"),
    )
    body = body.unionByName(top)
    return body.join(_digests(ends), "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


def _chains(turns: DataFrame, lone: DataFrame) -> DataFrame:
    """Nodes of the conversations that are alone from their turn ``start`` on, each to its end."""
    starts = lone.select("conv", "up", "start")
    on = turns.filter("at is not null").join(starts, "conv").filter("at >= start")
    last = F.col("at") + 1 == F.col("total")
    return on.select(
        F.lit(None).cast("binary").alias("box"),
        F.col("conv").alias("conv_id"),
        (F.col("at") + 1).alias("depth"),
        F.when(F.col("at") == F.col("start"), F.col("up")).otherwise(F.col("conv")).alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, _alone(F.col("conv"))).alias("key"),
    )


def _alone(conv: Column) -> Column:
    """Key of the end of a conversation that is alone; no digest of turns has this form."""
    return F.concat(F.lit("conv "), conv.cast("string")).cast("binary")


def _common(a: Column, b: Column) -> Column:
    """Leading elements that two arrays share."""
    differ = F.filter(
        F.transform(F.sequence(F.lit(1), F.least(F.size(a), F.size(b))), lambda i: F.when(F.element_at(a, i) != F.element_at(b, i), i)),
        lambda i: i.isNotNull(),
    )
    return F.coalesce(F.get(differ, F.lit(0)) - 1, F.least(F.size(a), F.size(b)))


def _grow(rows: DataFrame, box: int) -> tuple[list[DataFrame], DataFrame]:
    """All nodes under the heads that ``rows`` stand under, and each head's sums."""
    swept: list[DataFrame] = []
    bursts: list[DataFrame] = []
    rows = stored(rows.select(*_names(_ROWS)), "trie-rows")
    while True:
        weight = F.sum(F.size("rest"))
        sizes = rows.groupBy("box").agg(
            weight.alias("turns"), F.sum("n").alias("members"), F.min("low").alias("least"), F.min("rest").alias("a"), F.max("rest").alias("b")
        )
        large = sizes.filter((F.col("turns") > box) & (F.col("a") != F.col("b")))
        large = large.withColumn("shared", _common(F.col("a"), F.col("b")).cast("int"))
        large = stored(large.select("box", "members", "least", "shared"), "trie-bursts")
        if large.isEmpty():
            swept.append(stored(_sweep(rows), "trie-nodes"))
            break
        # Rows that end where their container branches: one a container at most.
        here = rows.join(large, "box")
        swept.append(stored(_sweep(rows.join(large.select("box"), "box", "left_anti")), "trie-nodes"))
        ended = F.size("rest") == F.col("shared")
        bursts.append(stored(_branches(here.withColumn("ended", ended)), "trie-branches"))
        following = F.element_at("rest", F.col("shared") + 1)
        child = F.unhex(F.md5(F.concat(F.col("box"), F.lit("/").cast("binary"), F.hex(following).cast("binary"))))
        rows = here.filter(~ended).select(
            child.alias("box"), (F.col("base") + F.col("shared")).alias("base"),
            # Without a chain they branch at the head itself, where other conversations may end.
            F.when(F.col("shared") > 0, F.col("least")).otherwise(F.col("up")).alias("up"),
            F.expr("slice(rest, shared + 1, size(rest))").alias("rest"), F.expr("slice(lens, shared + 1, size(lens))").alias("lens"),
            "n", "low", "key", "below_leaves", "below_saved", "below_children", F.col("box").alias("over"),
        )
        rows = stored(rows, "trie-rows")
        bursts[-1] = (bursts[-1], stored(rows.select("box", "over").distinct(), "trie-over"))
        rows = rows.drop("over")

    # Back up: children's sums complete the containers that burst into them.
    sums = _tops(swept[-1])
    for depth in range(len(bursts) - 1, -1, -1):
        burst, over = bursts[depth]
        children = sums.join(over, "box").groupBy(F.col("over").alias("box")).agg(
            F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"), F.sum("n_children").alias("c")
        )
        made = stored(_chain_nodes(burst.join(children, "box", "left")), "trie-chains")
        swept.append(made.filter("depth > 0").drop("top_children"))
        top = made.filter("top_children is not null").select(
            "box", "n_leaves", F.col("saved_tokens").alias("saved"), F.col("top_children").alias("n_children")
        )
        sums = stored(_tops(swept[depth]).unionByName(top), "trie-sums")
    return swept, sums.select(F.col("box").alias("head"), "n_leaves", "saved", "n_children")


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _tops(nodes: DataFrame) -> DataFrame:
    """Sums of each container's topmost nodes, which alone carry their container."""
    return nodes.filter("box is not null").groupBy("box").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"), F.count("*").alias("n_children")
    )


def _branches(here: DataFrame) -> DataFrame:
    """A row for each container that bursts: its chain of shared turns, and what ends or goes on at its end."""
    end = F.when(F.col("ended"), F.struct("key", "below_leaves", "below_saved", "below_children"))
    return here.groupBy("box", "base", "up", "members", "least", "shared").agg(
        F.max(end).alias("end"), F.min(F.struct("rest", "lens")).alias("first")
    ).select("box", "base", "up", "members", "least", "shared", "end", F.expr("slice(first.lens, 1, shared)").alias("lens"))


def _chain_nodes(bursts: DataFrame) -> DataFrame:
    """The nodes of each burst container's chain, from its children's sums ``l``, ``s`` and ``c``. A chain of
    no turn gives one row of depth 0, for its sums alone."""
    zero = F.lit(0).cast("long")
    some = lambda c: F.coalesce(F.col(c), zero)
    sums = bursts.select(
        "*",
        (some("l") + some("end.below_leaves")).alias("n_leaves"),
        (some("s") + some("end.below_saved")).alias("under"),
        (some("c") + some("end.below_children")).alias("kids"),
    )
    # From the chain's end up: position 0 is the container's base node.
    spread = sums.withColumn("step", F.explode(F.sequence(F.when(F.col("shared") > 0, 1).otherwise(0), F.col("shared"))))
    after = F.aggregate(F.expr("slice(lens, greatest(step, 1), size(lens))"), zero, lambda a, x: a + x)
    last, first = F.col("step") == F.col("shared"), F.col("step") == 1
    saved = F.col("under") + F.when(F.col("step") > 0, (F.col("members") - 1) * after).otherwise(0)
    return spread.select(
        F.when(F.col("step") <= 1, F.col("box")).alias("box"),
        F.col("least").alias("conv_id"),
        F.when(F.col("step") > 0, F.col("base") + F.col("step")).otherwise(0).alias("depth"),
        F.when(first, F.col("up")).otherwise(F.col("least")).alias("parent_conv_id"),
        F.col("members").alias("n_convs"),
        F.when(last, F.col("kids")).otherwise(1).cast("long").alias("n_children"),
        "n_leaves",
        saved.cast("long").alias("saved_tokens"),
        F.when(last, F.col("end.key")).alias("key"),
        # What the container counts as, to the one above: its top node, or its branches if it has no chain.
        F.when(F.col("step") == 0, F.col("kids")).when(first, 1).cast("long").alias("top_children"),
    )


def _sweep(rows: DataFrame) -> DataFrame:
    """The nodes of containers: rows are sorted by container and turns, and swept into nodes."""

    def nodes(found: list, out: dict) -> None:
        box, base, up = found[0][:3]
        parent, depth, n, low, kids, leaves, saved, length, ends = [], [], [], [], [], [], [], [], []
        path: list[int] = []
        before: list = []
        for _, _, _, rest, lens, count, least, key, b_leaves, b_saved, b_kids in found:
            same = 0
            for x, y in zip(before, rest):  # noqa: B905
                if x != y:
                    break
                same += 1
            del path[same:]
            for i in range(same, len(rest)):
                parent.append(path[-1] if path else -1)
                path.append(len(depth))
                depth.append(base + i + 1)
                length.append(lens[i])
                for column in (n, kids, leaves, saved):
                    column.append(0)
                low.append(least)
                ends.append(None)
            at = path[-1]
            n[at] += count
            low[at] = min(low[at], least)
            leaves[at] += b_leaves
            saved[at] += b_saved
            kids[at] += b_kids
            ends[at] = key
            before = rest
        for i in range(len(depth) - 1, -1, -1):  # a node comes after its parent
            if not kids[i]:
                leaves[i] = 1
            saved[i] += (n[i] - 1) * length[i]
            p = parent[i]
            if p >= 0:
                n[p] += n[i]
                low[p] = min(low[p], low[i])
                kids[p] += 1
                leaves[p] += leaves[i]
                saved[p] += saved[i]
        ups = [low[p] if p >= 0 else up for p in parent]
        tops = [box if p < 0 else None for p in parent]
        for name, values in zip(out, (tops, low, depth, ups, n, kids, leaves, saved, ends), strict=True):
            out[name] += values

    schema = pa.schema([(c, pa.binary() if c in ("box", "key") else pa.int64()) for c in _names(_NODES)])

    def run(batches):
        found: list = []
        out: dict[str, list] = {c: [] for c in schema.names}
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if found and found[0][0] != row[0]:
                    nodes(found, out)
                    found = []
                    if len(out["depth"]) > 20_000:
                        yield pa.RecordBatch.from_pydict(out, schema)
                        out = {c: [] for c in schema.names}
                found.append(row)
        if found:
            nodes(found, out)
        yield pa.RecordBatch.from_pydict(out, schema)

    names = _names(_ROWS)
    number = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.select(*names).repartition(number, "box").sortWithinPartitions("box", "rest")
    return dealt.mapInArrow(run, _NODES)


def _digests(ends: DataFrame) -> DataFrame:
    """(``key``, ``ends_sha256``): digest of the ids of the conversations that end at a node, in their order."""
    ends = stored(ends, "trie-ends").withColumnRenamed("conv", "id")
    ordered = placed(ends, ["key"], [F.col("id")], "place", "of")
    # Chunks of a bounded number of ids, each joined in a task of its own.
    ids = F.array_sort(F.collect_list("id"))
    chunks = ordered.groupBy("key", F.floor(F.col("place") / 4096).alias("chunk")).agg(F.concat_ws(",", F.transform(ids, lambda x: x.cast("string"))).alias("ids"))

    def run(batches):
        key = digest = None
        out: list = []
        for batch in batches:
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if digest is not None and k == key:
                    digest.update(b",")
                else:
                    if digest is not None:
                        out.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256()
                digest.update(ids.encode())
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.binary(), pa.string()))], ["key", "ends_sha256"])
                out = []
        if digest is not None:
            out.append((key, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.binary(), pa.string()))], ["key", "ends_sha256"])

    number = max(1, int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = chunks.repartition(number, "key").sortWithinPartitions("key", "chunk").select("key", "ids")
    return dealt.mapInArrow(run, "key binary, ends_sha256 string")
