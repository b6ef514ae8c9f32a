"""A corpus through five stages: quality, repeated lines, near duplicates, contamination, mixing.

Each stage takes all that the one before kept, as a written table. The first
four return the columns of documents; the last returns the mix: per document
its source, size, its source's size and target, how often it is repeated, and
the words so taken.

Defined results, beyond those of the operators: columns of documents that are
not named here are dropped; an empty table stays empty through all stages; rows
that repeat an id are told apart by their text, and of rows equal in both one
stays from the near-duplicate stage on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countlens.llm import contamination, jaccard, lines, mixing, quality
from countlens.llm.common import importable, stored, table
from countlens.llm.queries import contaminated

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _row_id():
    """Orders rows by id, null last, and tells rows that repeat an id apart by their text."""
    return F.struct(F.col("doc_id").isNull().alias("late"), F.col("doc_id"), F.xxhash64("text").alias("h"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject (score of 0.3 or more)."""
    importable(spark)
    everything = table(spark, sf_dir, "documents")
    weights = quality.learn(quality.training_rows(everything, table(spark, sf_dir, "labels")))
    scored = quality.score(docs, weights, keep=COLUMNS[1:])
    return scored.filter("score >= 0.3").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that equal an earlier line or are near to it; those left
    with no line go."""
    importable(spark)
    named = docs.select(*COLUMNS).withColumn("row_id", _row_id())
    gone = lines.duplicate_lines(named, id_col="row_id", min_chars=60, near_chars=60)
    left = lines.drop_lines(named.withColumn("had", F.col("text").isNotNull()), gone, id_col="row_id")
    left = left.filter("text is not null or not had")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near duplicates."""
    importable(spark)
    named = docs.select(*COLUMNS).withColumn("row_id", _row_id())
    classed = jaccard.classes(named, id_col="row_id")
    kept = classed.filter("row_id = component_id").select("row_id").distinct()
    return named.join(kept, "row_id", "left_semi").dropDuplicates(["row_id"]).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule doesn't name."""
    importable(spark)
    named = docs.select(*COLUMNS).withColumn("row_id", _row_id())
    index = contamination.build_index(named, id_col="row_id")
    found = contaminated(contamination.search(index, table(spark, sf_dir, "benchmark")))
    bad = found.filter("contaminated").select(F.col("doc_id").alias("row_id")).distinct()
    return named.join(bad, "row_id", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document."""
    importable(spark)
    return mixing.mix(docs)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_each_class),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: The learned classifier has no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage over all that the one before kept, by way of a written table."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"stage-{name}")
    return docs
