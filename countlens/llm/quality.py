"""Quality classifier (operator 7): logistic regression over hashed word n-grams, learned by
follow-the-regularised-leader (proximal, per-coordinate rates).

Tokens are runs of letters and digits or runs of marks, as written; features are
hashed runs of one and two tokens, and one more for all runs of twice the same
token, each with the share of the text's runs that it makes up. Rounds of training run in parallel: a fixed number of shards each
pass once over their labelled texts, then the driver averages the shards'
states, which have a fixed size. The model learns from at most ``max_rows``
labelled rows, those of the smallest hash of their id. A text's score is the
sparse dot product of its features with the broadcast weights; whole texts are
scored.

Defined results: null or empty texts have only the constant feature and so get
the learned base rate; with no labelled row every score is 0.5; a null label or
null id is not learned from; repeated ids are learned from as often as the join
with labels gives them; columns beyond those named are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countlens.llm import text as tx
from countlens.llm.common import stored
from countlens.llm.langid import held_out

_B = np.arange(256)
_LETTER = ((_B >= 48) & (_B <= 57)) | ((_B >= 65) & (_B <= 90)) | ((_B >= 97) & (_B <= 122)) | (_B >= 128)
_KIND = np.where(_LETTER, 1, np.where(tx.SPACED, 2, 0)).astype(np.int8)
SCALE = 8.0
SHARDS = 8
SAME = np.uint64(0xA5A5_5A5A_1234_5678)  # hash of the feature of a token twice in a row


def token_runs(column) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token of a string column and the n + 1 offsets of its rows."""
    data, at = tx.utf8(column)
    kind = _KIND[data]
    starts, ends = tx.word_bounds(data, at, _KIND == 1)
    s2, e2 = tx.word_bounds(data, at, _KIND == 2)
    starts, ends = np.concatenate([starts, s2]), np.concatenate([ends, e2])
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    del kind
    return tx.hash_ranges(data, starts, ends), np.searchsorted(starts, at)


def features(column, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of each row's token runs of one and two, with the row of each."""
    h, at = token_runs(column)
    row = tx.row_of(at)
    one, next_one = h[:-1], h[1:]
    pair = row[1:] == row[:-1]
    two = tx.mix(one * np.uint64(3) + next_one * np.uint64(0x9E3779B97F4A7C15))[pair]
    same = pair & (one == next_one)
    f = np.concatenate([h, two, np.full(int(same.sum()), SAME)]) >> np.uint64(64 - bits)
    return f.astype(np.int64), np.concatenate([row, row[:-1][pair], row[:-1][same]])


class Leader:
    """State of follow-the-regularised-leader for logistic loss; the last coordinate is the constant."""

    def __init__(self, z: np.ndarray, n: np.ndarray, alpha=0.5, beta=1.0, l1=0.002, l2=0.1):
        self.z, self.n = z.astype(np.float64), n.astype(np.float64)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, i=slice(None)) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def step(self, i: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(i)
        g = (1.0 / (1.0 + np.exp(-float(np.clip(w @ x, -35, 35)))) - y) * x
        sigma = (np.sqrt(self.n[i] + g * g) - np.sqrt(self.n[i])) / self.alpha
        self.z[i] += g - sigma * w
        self.n[i] += g * g


def learn(labelled: DataFrame, *, bits: int = 18, max_rows: int = 16000, rounds: int = 3) -> np.ndarray:
    """Weights (2**bits features and a constant) from rows (id, ``text``, ``label`` 0 or 1)."""
    spark = labelled.sparkSession
    size = 2**bits

    def featurise(batches):
        for batch in batches:
            for part in tx.slices(batch, "text"):
                f, row = features(part.column(1), bits)
                key, count = np.unique(row * size + f, return_counts=True)
                cut = np.searchsorted(key, np.arange(part.num_rows + 1) * size)
                idx = [(key[a:b] % size).astype("<i4").tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                x = [
                    (SCALE * count[a:b] / max(1, count[a:b].sum())).astype("<f4").tobytes()
                    for a, b in zip(cut[:-1], cut[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(idx, pa.binary()), pa.array(x, pa.binary()), part.column(2)],
                    ["shard", "idx", "x", "label"],
                )

    rows = labelled.select("shard", F.col("text"), F.col("label").cast("int").alias("label"))
    rows = rows.mapInArrow(featurise, "shard int, idx binary, x binary, label int")
    rows = stored(rows.repartition(SHARDS, "shard").sortWithinPartitions("shard", F.xxhash64("idx", "x")), "quality-rows")
    rows = rows.repartition(SHARDS, "shard").sortWithinPartitions("shard", F.xxhash64("idx", "x"), "label")
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((z.astype(np.float32), n.astype(np.float32)))

        def one_pass(batches, shared=shared):
            state, seen = None, 0
            for batch in batches:
                for i, x, y in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                    state = state or Leader(*shared.value)
                    i = np.append(np.frombuffer(i.as_py(), "<i4"), size)
                    state.step(i, np.append(np.frombuffer(x.as_py(), "<f4"), 1.0), y.as_py())
                    seen += 1
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([seen]), *(pa.array([v.astype("<f4").tobytes()]) for v in (state.z, state.n))],
                    ["seen", "z", "n"],
                )

        states = rows.mapInArrow(one_pass, "seen long, z binary, n binary").collect()  # a fixed number of fixed sizes
        shared.unpersist()
        if not states:
            break
        share = np.array([s["seen"] for s in states], dtype=float)
        share /= share.sum()
        z = sum(w * np.frombuffer(s["z"], "<f4") for w, s in zip(share, states, strict=True))
        n = sum(w * np.frombuffer(s["n"], "<f4") for w, s in zip(share, states, strict=True))
    return Leader(z, n).weights().astype(np.float32)


def training_rows(docs: DataFrame, labels: DataFrame, *, label_col="quality", max_rows: int = 16000) -> DataFrame:
    """At most ``max_rows`` labelled rows outside the held-out fold, dealt over the shards by a hash."""
    key = F.xxhash64(F.col("doc_id"))
    usable = labels.filter(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    picked = usable.select("doc_id", F.col(label_col).alias("label")).orderBy(key, "doc_id", "label").limit(max_rows)
    picked = picked.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SHARDS)).cast("int"))
    return docs.select("doc_id", F.col("text")).join(F.broadcast(picked), "doc_id").select("shard", "text", "label")


def score(docs: DataFrame, weights: np.ndarray, *, id_col="doc_id", text_col="text", keep=()) -> DataFrame:
    """Per document: id, ``held_out``, ``score``; ``keep`` names columns to carry along."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    bits = int(np.log2(len(weights) - 1))
    kept = [F.col(c).alias(f"_kept_{i}") for i, c in enumerate(keep)]

    def run(batches):
        w = shared.value
        for batch in batches:
            for part in tx.slices(batch, "text"):
                f, row = features(part.column(2), bits)
                dot = np.bincount(row, weights=w[f], minlength=part.num_rows)
                total = np.bincount(row, minlength=part.num_rows)
                logit = w[-1] + SCALE * dot / np.maximum(total, 1)
                p = 1.0 / (1.0 + np.exp(-np.clip(logit, -35, 35)))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(part.num_columns)), pa.array(p)],
                    [*part.schema.names, "score"],
                )

    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"), *kept)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    out = rows.mapInArrow(run, f"{schema}, score double")
    back = [F.col(f"_kept_{i}").alias(c) for i, c in enumerate(keep)]
    return out.select(F.col("id").alias(id_col), "held_out", "score", *back)
