"""Small tables with every odd case, and brute-force versions of what SQL can't express."""

from __future__ import annotations

import random
import re

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside: extra columns of these names must not matter.
CLASHES = ("id", "doc", "row", "size", "key", "h", "n", "line", "place", "draw", "score", "held_out", "start", "sig", "rank", "gram", "node")


def rows_of(path: str, table: str) -> list[dict]:
    import pyarrow.parquet as pq

    return pq.read_table(f"{path}/{table}.parquet").to_pylist()


def odd_texts() -> list[str | None]:
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    long = " ".join(rng.choice(vocabulary) for _ in range(60_000))
    base = [rng.choice(vocabulary) for _ in range(120)]
    near = list(base)
    near[60] = "changed"
    far = base[:60] + [rng.choice(vocabulary) for _ in range(60)]
    texts = [None, "", " \t\n", "one", "one two three", "One TWO three", "é", "12 34 --", long, long + " tail"]
    texts += [" ".join(base), " ".join(base), " ".join(near), " ".join(far), "x" * 5000, "x" * 5000 + "y", "ab" * 300]
    return texts


def odd_docs(spark, texts=None, extra: bool = True):
    """Rows with null ids, repeated rows, null sources and columns whose names clash."""
    texts = odd_texts() if texts is None else texts
    rows = [(i, t, ["en", "fr", None][i % 3], ["s1", "s0", None][i % 3], len(t or "")) for i, t in enumerate(texts)]
    rows += rows[-6:] + [(None, t, None, None, None) for t in texts[-4:]] + [(3, "one two three", "en", "s1", 13)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    if extra:
        from pyspark.sql import functions as F

        for c in CLASHES:
            df = df.withColumn(c, F.lit("clash"))
    return df


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


SPACED = re.compile(r"[^\x20\x09-\x0D]+")
_LOW = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def spaced_words(text: str | None) -> list[str]:
    return SPACED.findall((text or "").translate(_LOW))


class Union:
    def __init__(self, n: int):
        self.of = list(range(n))

    def find(self, x: int) -> int:
        while self.of[x] != x:
            self.of[x] = self.of[self.of[x]]
            x = self.of[x]
        return x

    def join(self, a: int, b: int) -> None:
        self.of[self.find(a)] = self.find(b)

    def least(self, ids: list) -> list:
        """For each row the least id of its class that is not null."""
        low: dict = {}
        for i, x in enumerate(ids):
            r = self.find(i)
            if x is not None and (low.get(r) is None or x < low[r]):
                low[r] = x
        return [low.get(self.find(i)) for i in range(len(ids))]
