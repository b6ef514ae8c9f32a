"""The registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countlens.llm import contamination, credentials, embeddings, jaccard, langid, licenses, lines, merkle, mixing, oracles, quality, repeats, turns, warc
from countlens.llm.common import table


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    train = docs.filter(F.col("doc_id").isNotNull() & ~langid.held_out())
    return langid.predict(docs, langid.learn(train))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    id_type = pages.schema["page_id"].dataType
    got = warc.read_records(warc.write_archives(pages), payload=False)
    return got.select(
        F.col("page_id").cast(id_type).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"),
    )


def op5_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = contamination.build_index(table(spark, sf_dir, "documents"))
    return contaminated(contamination.search(index, table(spark, sf_dir, "benchmark")))


def contaminated(found: DataFrame) -> DataFrame:
    """The contract's columns, from the search's hits and items."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    listed = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return (
        found.withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.concat_ws(",", listed), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
        .select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return credentials.scan(docs, words=credentials.learn_words(docs))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = quality.learn(quality.training_rows(docs, table(spark, sf_dir, "labels")))
    scored = quality.score(docs, weights)
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that go, per document that has any: their number, and the line numbers."""
    gone = lines.duplicate_lines(table(spark, sf_dir, "documents"), min_chars=60, near_chars=60)
    numbers = F.array_sort(F.collect_list("line"))
    return gone.groupBy("doc_id").agg(
        F.count("*").alias("n_removed"),
        F.count(F.when(F.col("kind") == "near", 1)).alias("n_near"),
        numbers.alias("removed"),
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.removed(table(spark, sf_dir, "documents"), kept=False)
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        n_removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
    )


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    starts = F.transform("base", lambda x: x["at"])
    base = F.array_sort(F.array_distinct(F.transform("base", lambda x: x["label"])))
    own = F.transform("matches", lambda x: x["label"])
    best = F.coalesce(F.get(F.transform("matches", lambda x: x["score"]), F.lit(0)), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )


def op12_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.trie(turns.rebuilt(turns.numbered(table(spark, sf_dir, "conversations"))))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.manifest(table(spark, sf_dir, "documents"), carry={"tampered": merkle.tampered_leaf()})
    found = found.withColumn("folded_root", merkle.folded(F.col("tampered"), F.col("path")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {
    "op1_embeddings": op1_embeddings,
    "op2_langid": op2_langid,
    "op3_jaccard": op3_jaccard,
    "op4_warc": op4_warc,
    "op5_contamination": op5_contamination,
    "op6_secrets": op6_secrets,
    "op7_quality": op7_quality,
    "op8_lines": op8_lines,
    "op9_mixing": op9_mixing,
    "op10_repeats": op10_repeats,
    "op11_licenses": op11_licenses,
    "op12_turns": op12_turns,
    "op13_merkle": op13_merkle,
}

ORACLE_SQL = {
    "op9_mixing": mixing.MIX_SQL,
    "op11_licenses": oracles.licenses_sql(
        licenses.TEMPLATES, licenses.BASE_PHRASES, licenses.RARE, licenses.BAND, licenses.MIN_SCORE
    ),
    "op12_turns": oracles.TURNS_SQL,
    "op13_merkle": oracles.MERKLE_SQL,
}
