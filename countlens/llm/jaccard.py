"""N-gram Jaccard join (operator 3): parity sketches, joined by pigeonhole, verified exactly.

A text is the set of its word 5-grams. Sets a and b link when
100 * |a & b| >= 75 * |a | b|, that is when |a ^ b| <= (|a| + |b|) / 7.

Sketches. Each member of a set flips one bit of the set's bit sketch, so the
Hamming distance of two sketches is at most the size of the symmetric
difference: pairs whose sketches are further apart than the bound can't link.
Sketches grow with the set by powers of two and fold onto smaller ones.

Pigeonhole. By size band (a factor of two; sets near the top of a band also
join in the next one, where their larger partners are), members are dealt into
2**band parts by hash and each part is XOR-hashed. A difference of d members
changes d parts at most, so linking sets agree in many parts: about 0.43 of
2**band of them. Parts whose XOR-hash falls below a common threshold, about 48
a set, are the join keys: about 27 of them agree for sets that just link, and
the chance that none does is below 1e-11, near that of an error of the hashes.
In bands below 64 each member is a part of its own and all are keys.

Common keys. A passage that many unlike texts hold makes keys that all of them
share. So, by how many sets have a key, each set leaves out its commonest ones.
Of n members that are keys themselves, all but the n // 4 + 1 rarest go: a set that
links lacks n // 4 of them at most, so the rarest key that two linking sets
share is always among those of both. Where all of 64 parts are keys, all but the
n // 3 + 1 rarest go, as no more than n // 3 parts differ. In larger bands the SPARED
commonest go, and sets that share more keys than that still share one left; of
about 27, the chance that sets that just link share no more is below 1e-7.

Groups. Sets that share a key are a group. First each member is tested against
one leader of the group only: the member that shares most. Links found connect
classes, and then, in groups with members of several classes, the rest of the
cross-class pairs is tested on their sketches, in blocks of bounded size inside
tasks; what passes is verified. A group of near copies thus costs rows in
proportion to its size; equal sets are one node from the start.

Defined results: a null or empty text has no words, size 0 and its own class; a
text of fewer than five words is one shingle; a null id takes part, and the
class is its smallest non-null id; repeated rows are classed alike. Other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countlens.llm import text as tx
from countlens.llm.common import bitmap, in_bitmap, parts, stored
from countlens.llm.components import components

_U = np.uint64
SHINGLE = 5
TOKEN_BAND = 6  # in bands below, each member is a part
KEYS = 64  # of 2**band parts, so many are keys, the empty ones among them
SPARED = 4  # keys that a set leaves out of a band of hashed parts, the commonest
SKETCH_BAND = 8  # sets of up to 2**(this + 1) members have sketches of SKETCH_BITS bits
SKETCH_BITS = 1024
BLOCK = 4096


def bound(a, b):
    """The largest symmetric difference of linking sets of sizes a and b."""
    return (a + b) // 7


def band_of(n: int) -> int:
    return max(int(n).bit_length() - 1, TOKEN_BAND - 1)


def sketch(members: np.ndarray) -> np.ndarray:
    """Parity bits of a set, as 64-bit words; a power of two of them."""
    bits = SKETCH_BITS << max(0, band_of(len(members)) - SKETCH_BAND)
    place = tx.mix(members + _U(0x5851F42D4C957F2D)) & _U(bits - 1)
    flips = np.bincount(place.astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.uint64)


def fold(s: np.ndarray, words: int) -> np.ndarray:
    while s.shape[-1] > words:
        half = s.shape[-1] // 2
        s = s[..., :half] ^ s[..., half:]
    return s


def part_keys(members: np.ndarray, band: int) -> np.ndarray:
    """Join keys of a set in a band."""
    if band < TOKEN_BAND:
        return tx.mix(members ^ _U(band + 1))
    part = (members >> _U(64 - band)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part = part[order]
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    xored = np.bitwise_xor.reduceat(tx.mix(members[order] + _U(1)), first)
    keys = tx.mix(xored + part[first].astype(_U) * _U(0x9E3779B97F4A7C15) + _U(band))
    limit = min(1.0, KEYS / (1 << band))
    return keys if limit == 1.0 else keys[tx.mix(keys) < _U(int(limit * float(1 << 64)))]


def band_keys(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of a set in its band, and in the next one if it joins there too."""
    n, band = len(members), band_of(len(members))
    also = 4 * n >= 3 << (band + 1)
    return part_keys(members, band), part_keys(members, band + 1) if also else members[:0]


def keys_of(members: np.ndarray) -> np.ndarray:
    return np.concatenate(band_keys(members))


def signature(members: np.ndarray) -> int:
    """63 bits that stand for the set."""
    total = tx.mix(members).sum(dtype=_U) ^ _U(len(members))
    return int(tx.mix(np.array([total], _U))[0] >> _U(1))


def _sets(batches):
    """(row slice, list of sorted member arrays) of Arrow batches whose ``text`` is second."""
    for batch in batches:
        for part in tx.slices(batch, "text"):
            h, at = tx.words(part.column(1), tx.SPACED)
            g, at = tx.shingles(h, at, SHINGLE)
            yield part, [np.unique(g[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def _signed(arrays: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(arrays) if arrays else np.zeros(0, _U)
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(flat).view(np.int64)))


def _profiles(rows: DataFrame) -> DataFrame:
    """(doc, n, sig, sketch, keys, next_keys) per row."""
    id_type = rows.schema["doc"].dataType.simpleString()

    def run(batches):
        for part, sets in _sets(batches):
            keys = [band_keys(s) if len(s) else (s, s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([signature(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([sketch(s).tobytes() for s in sets], pa.binary()),
                    _signed([k for k, _ in keys]),
                    _signed([k for _, k in keys]),
                ],
                ["doc", "n", "sig", "sketch", "keys", "next_keys"],
            )

    return rows.mapInArrow(run, f"doc {id_type}, n long, sig long, sketch binary, keys array<long>, next_keys array<long>")


def _shared_keys(nodes: DataFrame) -> DataFrame:
    """(sig, key, weight) of the keys that several sets have, without each set's commonest ones;
    ``weight`` sums over a set's keys how many sets have each."""

    def spared(keys: str, *least):  # but for so many keys, by the sizes below which they do
        rule = F.lit(SPARED)
        for below, part in reversed(least):
            rule = F.when(F.col("n") < below, F.size(keys) - F.floor(F.col("n") / part).cast("int") - 1).otherwise(rule)
        return rule.alias("spared")

    small, parted = 1 << TOKEN_BAND, 2 * KEYS
    own = nodes.select("sig", F.explode("keys").alias("key"), F.lit(False).alias("next"), spared("keys", (small, 4), (parted, 3)))
    beyond = nodes.select("sig", F.explode("next_keys").alias("key"), F.lit(True).alias("next"), spared("next_keys", (KEYS, 3)))
    keys = own.union(beyond)
    counted = keys.groupBy("key").agg(F.count("*").alias("f")).filter("f > 1")
    # Keys of one set alone are rarer than all of these, so the commonest are found without them.
    ranked = keys.join(counted, "key").repartition("sig")
    commonest = Window.partitionBy("sig", "next").orderBy(F.desc("f"), F.desc("key"))
    ranked = ranked.withColumn("common", F.row_number().over(commonest)).filter("common > spared")
    return ranked.select("sig", "key", F.sum("f").over(Window.partitionBy("sig")).alias("weight"))


def _near_by_sketch(pairs: DataFrame, nodes: DataFrame, tasks: int) -> DataFrame:
    """Pairs (x, y) whose sketches are no further apart than linking sets may be."""
    x = nodes.select(F.col("sig").alias("x"), F.col("n").alias("nx"), F.col("sketch").alias("sx"))
    y = nodes.select(F.col("sig").alias("y"), F.col("n").alias("ny"), F.col("sketch").alias("sy"))
    both = pairs.join(x, "x").join(y, "y").filter("4 * least(nx, ny) >= 3 * greatest(nx, ny)")

    def run(batches):
        for batch in batches:
            ok = []
            for nx, ny, sx, sy in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
                sx, sy = np.frombuffer(sx, np.uint64), np.frombuffer(sy, np.uint64)
                words = min(len(sx), len(sy))
                apart = int(np.bitwise_count(fold(sx, words) ^ fold(sy, words)).sum())
                ok.append(apart <= bound(nx, ny))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return both.select("x", "y", "nx", "ny", "sx", "sy").coalesce(tasks).mapInArrow(run, "x long, y long")


def _near_in_groups(members: DataFrame, nodes: DataFrame, total: int) -> DataFrame:
    """Pairs of different classes within groups (key, sig, component, f) that are near by sketch.

    A group of f members is dealt into f / BLOCK blocks, and each pair of blocks is compared in one task.
    """
    blocks = F.ceil(F.col("f") / F.lit(BLOCK)).cast("int")
    mine = F.pmod(F.xxhash64("sig"), blocks).cast("int")
    dealt = members.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select(
        "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "sig", "component"
    ).join(nodes.select("sig", "n", "sketch"), "sig")
    dealt = dealt.select("key", "i", "j", "mine", "sig", "component", "n", "sketch")
    dealt = dealt.repartition(parts(total, 20_000), "key", "i", "j").sortWithinPartitions("key", "i", "j", "n", "sig")

    def compare(i, j, mine, sig, component, n, sketches):
        words = min(map(len, sketches)) // 8
        s = np.stack([fold(np.frombuffer(x, np.uint64), words) for x in sketches])
        top = np.searchsorted(n, (4 * n) // 3, side="right")  # partners are at most a third larger
        for k in range(len(n) - 1):
            if top[k] <= k + 1:
                continue
            rest = slice(k + 1, top[k])
            ok = component[rest] != component[k]
            if i != j:
                ok &= mine[rest] != mine[k]
            where = np.flatnonzero(ok) + k + 1
            if len(where):
                apart = np.bitwise_count(s[where] ^ s[k]).sum(axis=1, dtype=np.int64)
                for m in where[apart <= bound(n[k], n[where])].tolist():
                    yield (int(min(sig[k], sig[m])), int(max(sig[k], sig[m])))

    def run(batches):
        held, rows = None, []

        def flush():
            if len(rows) < 2:
                return
            _, i, j, *columns = zip(*rows, strict=True)
            numbers = [np.array(c, np.int64) for c in columns[:4]]
            found = set(compare(i[0], j[0], *numbers, columns[4]))
            if found:
                x, y = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["x", "y"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held != row[:3]:
                    yield from flush()
                    held, rows = row[:3], []
                rows.append(row)
        yield from flush()

    return dealt.mapInArrow(run, "x long, y long").distinct()


def _members(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sig, members) of the wanted (sig, rep), by a second pass over the wanted texts."""
    id_type = rows.schema["doc"].dataType.simpleString()
    key = F.xxhash64("doc").alias("key")
    shared = rows.sparkSession.sparkContext.broadcast(bitmap(wanted.select(F.xxhash64("rep").alias("key")), "key"))

    def run(batches):
        bits = shared.value
        some = (b.filter(pa.array(in_bitmap(bits, b.column(2).to_numpy()))) for b in batches)
        for part, sets in _sets(some):
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([signature(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["doc", "sig", "members"],
            )

    got = rows.select("doc", "text", key).mapInArrow(run, f"doc {id_type}, sig long, members binary").alias("g")
    same = (F.col("g.sig") == F.col("w.sig")) & F.col("g.doc").eqNullSafe(F.col("w.rep"))
    return got.join(wanted.alias("w"), same, "left_semi").select("sig", "members").dropDuplicates(["sig"])


def _linked(pairs: DataFrame, rows: DataFrame, nodes: DataFrame, tasks: int) -> DataFrame:
    """The pairs whose sets link, by counting common members."""
    wanted = pairs.select(F.col("x").alias("sig")).union(pairs.select("y")).distinct()
    sets = stored(_members(rows, wanted.join(nodes.select("sig", "rep"), "sig")), "sets")
    both = pairs.join(sets.select(F.col("sig").alias("x"), F.col("members").alias("a")), "x").join(
        sets.select(F.col("sig").alias("y"), F.col("members").alias("b")), "y"
    )

    def run(batches):
        for batch in batches:
            ok = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8")
                a, b = (a, b) if len(a) <= len(b) else (b, a)
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                common = int((b[at] == a).sum())
                ok.append(100 * common >= 75 * (len(a) + len(b) - common))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return both.select("x", "y", "a", "b").coalesce(tasks).mapInArrow(run, "x long, y long")


def classes(docs: DataFrame, *, id_col="doc_id", text_col="text") -> DataFrame:
    """Per row: id, ``n_shingles`` and ``component_id``."""
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    profiles = stored(_profiles(rows), "shingle-profiles")
    some = profiles.filter("sig is not null")
    nodes = stored(
        some.groupBy("sig").agg(
            F.min("doc").alias("rep"),
            *(F.first(c).alias(c) for c in ("n", "sketch", "keys", "next_keys")),
        ),
        "shingle-sets",
    )
    members = stored(_shared_keys(nodes), "shared-keys")
    groups = members.groupBy("key").agg(F.max(F.struct("weight", "sig")).alias("lead"), F.count("*").alias("f")).filter("f > 1")
    members = members.select("sig", "key").join(groups.select("key", "f", F.col("lead.sig").alias("lead")), "key")
    members = stored(members, "shared-groups")
    # The leaders' round tests no more pairs than the groups have rows.
    total = members.count()
    tasks = parts(total, 20_000)
    pair = [F.least("sig", "lead").alias("x"), F.greatest("sig", "lead").alias("y")]
    first = members.filter("sig <> lead").select(*pair).distinct()
    first = stored(_near_by_sketch(first, nodes, tasks), "pairs")
    links = stored(_linked(first, rows, nodes, tasks), "links")

    so_far = components(links).withColumnRenamed("node", "sig")
    members = members.filter("f > 2 and sig <> lead").join(so_far, "sig", "left")
    members = members.withColumn("component", F.coalesce("component", "sig"))
    members = stored(members, "classed-groups")
    mixed = members.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b").select("key")
    rest = members.join(mixed, "key", "left_semi")
    second = _near_in_groups(rest, nodes, total)
    second = stored(second.join(first, ["x", "y"], "left_anti"), "pairs")
    links = links.union(_linked(second, rows, nodes, tasks))

    final = components(links).withColumnRenamed("node", "sig")
    named = nodes.select("sig", "rep").join(final, "sig")
    named = named.groupBy("component").agg(F.min("rep").alias("least")).join(final, "component").select("sig", "least")
    named = nodes.select("sig", "rep").join(named, "sig", "left").select("sig", F.coalesce("least", "rep").alias("least"))
    out = profiles.select("doc", "n", "sig").join(named, "sig", "left")
    return out.select(
        F.col("doc").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("sig").isNull(), F.col("doc")).otherwise(F.col("least")).alias("component_id"),
    )
