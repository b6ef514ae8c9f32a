"""Mixing sources to target weights (operator 9): capped water-filling.

Each source gets a share of the mix by its weight, but no more than
``max_epochs`` times its size; what a capped source leaves is shared among the
others by weight until no target is above its cap. The targets follow from one
row per source. Documents are then repeated whole ``floor(target / size)``
times, and the fraction left is met by one more repetition of a seeded part of
the source: documents in the order of a hash of their id and text, as long as the
middle of a document's words lies within the fraction. Where that ends is found
from sums over ever finer hash slices, so no source is ever gathered or sorted in
one task. Rows equal in id and text share a hash; of those at the end as many are
taken as fit, by their places among each other. A large source is salted where
documents meet their source's target.

Defined results: null text has size 0; null source is a source, the last; null and
repeated ids are told apart by their text; repeated rows are separate documents,
of which some may be taken once more than others; sizes of 0 take 0; an empty table
gives no rows. Columns beyond the three named are ignored. The targets are one row
per source, ordered in one task: made for sources by the thousand, not for hosts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countlens.llm.common import stored
from countlens.operators.ordering import placed

WORD = r"[^\x20\x09-\x0D]+"
SLICE = 3  # hex digits of a level of hash slices
SALTS = 64  # parts of a source in the join with its plan


def water_fill(sources: DataFrame, total_share: float, max_epochs: int) -> DataFrame:
    """Targets of sources (columns ``source``, ``weight``, ``source_size``), by column ``target``.

    One row per source goes through one ordered pass: with sources ordered by
    cap over weight, the capped ones come first, and the level of the others is
    (total - capped) / (weight of the others).
    """
    cap = F.col("source_size") * F.lit(max_epochs)
    ranked = sources.withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        ranked.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(total_share)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0)))
        .withColumn("capped_before", F.coalesce(F.sum("cap").over(upto), F.lit(0)))
        .withColumn("level", (F.col("total") - F.col("capped_before")) / F.col("weight_left"))
        .withColumn("place", F.row_number().over(by_ratio))
    )
    # The level of the first source that stays below its cap is the level of all later ones.
    first_free = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))).over(everything)
    level = first_free["level"]
    target = F.when(level.isNull() | (F.col("ratio") <= level), F.col("cap").cast("double")).otherwise(
        level * F.col("weight")
    )
    return ranked.select("source", "weight", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1),
    total_share: float = 1.5,
    max_epochs: int = 2,
    seed: int = 17,
) -> DataFrame:
    """One row per document: id, ``source``, ``size``, ``source_size``, ``target``,
    ``repeats`` (times the mix takes the document) and ``taken`` (words so taken).

    Sources in code-point order, null last, have the weights in turn.
    """
    said = [F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_col, text_col)]]
    draw = F.md5(F.concat_ws(":", *said))
    sized = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            draw.alias("draw"),
        ),
        "mix-sizes",
    )
    slices = sized.groupBy("source", F.substring("draw", 1, SLICE).alias("slice")).agg(F.sum("size").alias("size"))
    slices = stored(slices, "mix-slices")
    sources = slices.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1).cast("int"))
    targets = water_fill(sources.withColumn("weight", weight), total_share, max_epochs)
    targets = targets.withColumn(
        "whole",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"),
    ).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    targets = stored(targets, "mix-targets")

    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    # Per source, the slice in which the words reach beyond ``rest``, and the words before it.
    cut = targets.select("source", F.lit("").alias("cut"), F.lit(0).cast("long").alias("before"), "rest")
    for length in (SLICE, 2 * SLICE, 32):
        if length == SLICE:
            sums = slices
        else:
            inside = same("d", "c") & (F.substring("d.draw", 1, shorter) == F.col("c.cut"))
            inner = sized.alias("d").join(cut.alias("c"), inside).select("d.source", F.substring("d.draw", 1, length).alias("slice"), "d.size")
            sums = inner.groupBy("source", "slice").agg(F.sum("size").alias("size"))
        shorter = length
        ordered = Window.partitionBy("s.source").orderBy("s.slice").rowsBetween(Window.unboundedPreceding, 0)
        upto = F.col("c.before") + F.sum("s.size").over(ordered)
        reached = sums.alias("s").join(cut.alias("c"), same("s", "c"))
        reached = reached.select("s.source", "s.slice", "s.size", "c.rest", upto.alias("upto")).filter("upto > rest")
        first = F.min(F.struct("slice", (F.col("upto") - F.col("size")).alias("before"), "rest"))
        cut = reached.groupBy("source").agg(first.alias("x"))
        cut = stored(cut.select("source", F.col("x.slice").alias("cut"), "x.before", "x.rest"), "mix-cuts")
    plan = targets.alias("t").join(cut.alias("c"), same("t", "c"), "left").select("t.*", "c.cut", "c.before")
    plan = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = sized.withColumn("salt", F.pmod(F.hash("draw"), F.lit(SALTS)))
    met = salted.alias("d").join(plan.alias("p"), same("d", "p") & (F.col("d.salt") == F.col("p.salt")))
    columns = ["d.id", "d.source", "d.size", "d.draw", *[f"p.{c}" for c in ("source_size", "target", "whole", "rest", "cut", "before")]]
    met = met.select(*columns)
    at_cut = F.coalesce(F.col("draw") == F.col("cut"), F.lit(False))
    others = met.filter(~at_cut).withColumn("more", F.coalesce(F.col("draw") < F.col("cut"), F.lit(False)))
    ties = placed(stored(met.filter(at_cut), "mix-ties"), ["source"], [F.col("id").asc_nulls_first()])
    middle = F.col("before") + (F.col("place") + 1) * F.col("size") - F.col("size") / 2
    ties = ties.withColumn("more", middle <= F.col("rest")).select(*others.columns)
    repeats = F.col("whole") + F.col("more").cast("long")
    return others.unionByName(ties).select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "size",
        "source_size",
        "target",
        repeats.cast("long").alias("repeats"),
        (F.col("size") * repeats).cast("long").alias("taken"),
    )


MIX_SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS draw
  FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT source, source_size, 2 * source_size AS cap,
         CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sums),
ranked AS (
  SELECT *, cap::DOUBLE / weight AS ratio,
         (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER before, 0)::DOUBLE)
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level,
         row_number() OVER (ORDER BY cap::DOUBLE / weight, encode(source) NULLS LAST) AS place
  FROM weighted
  WINDOW before AS (ORDER BY cap::DOUBLE / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
free AS (SELECT arg_min(level, place) AS level FROM ranked WHERE level <= ratio),
targets AS (
  SELECT source, source_size,
         CASE WHEN free.level IS NULL OR ratio <= free.level THEN cap::DOUBLE ELSE free.level * weight END AS target
  FROM ranked, free),
goals AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM targets),
rests AS (SELECT *, target - whole * source_size AS rest FROM goals),
placed AS (
  SELECT d.*, r.source_size, r.target, r.whole, r.rest, row_number() OVER (PARTITION BY d.source ORDER BY draw) AS place
  FROM sized d JOIN rests r ON d.source IS NOT DISTINCT FROM r.source),
marked AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place ROWS UNBOUNDED PRECEDING) - size / 2 AS middle,
         sum(size) OVER (PARTITION BY source) AS words FROM placed)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN middle <= rest AND words > rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM marked
"""
