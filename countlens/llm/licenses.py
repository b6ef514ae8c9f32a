"""Licence scan (operator 11): a positional index of rare licence words, in Spark SQL functions only.

Licence texts are templates of words. How rare a template word is follows from
all documents: one pass counts the documents that hold it. The index keeps each
template's rarest words (half of its distinct ones, at most ``RARE``) with their
postings, the positions in the template. A second pass looks up every rare
licence word of a document, with its positions, and writes a narrow row per
document. Each document position less a template position is where the template would start;
postings that agree on it, give or take what an edit moves (overlapping bands of
``BAND`` words), are intersected by grouping, and their weights, in parts of the
template's, are the match's score. A match of ``MIN_SCORE`` or more is a label
if the document has all the template's mandatory key phrases.

Base labels are phrases whose words stand one after the other.

Scale: texts are read twice and never shuffled; what is shuffled are counts of
template words and the postings met, keyed by document, template and band. The
templates bound the words and index rows that reach the driver or are broadcast.
No document is cut, and no number of postings or matches is capped.

Defined results: null text is empty; an empty text has no words, labels or
score; ties in rarity go by the word; rows that repeat an id, or have none, are documents of
their own; an empty table gives no rows. Columns not named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from countlens.llm.common import stored

# Characters of words, and letters that are folded.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases of the base labels.
BASE_PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Licence notices, as (label, text, mandatory key phrases).
TEMPLATES = (
    ("mit", "Released under the MIT License.", ("mit license",)),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
        "whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software.",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0.", ("apache license version 2",)),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at. Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied. See the License for the specific language governing permissions and limitations "
        "under the License.",
        ("apache license version 2", "in compliance with the license"),
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
        ("redistribution and use in source and binary forms", "redistributions of source code must retain"),
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        ("permission to use copy modify", "with or without fee is hereby granted"),
    ),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3.", ("gnu general public license version 3",)),
    (
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        ("gnu general public license", "version 3 of the license"),
    ),
    (
        "gpl-2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or any later version.",
        ("gnu general public license", "version 2 of the license"),
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation.",
        ("gnu lesser general public license",),
    ),
    (
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, you can obtain one.",
        ("mozilla public license v 2",),
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0.", ("cc by nc",)),
    (
        "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        ("creative commons attribution noncommercial",),
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License.", ("creative commons attribution 4",)),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
        ("free and unencumbered software released into the public domain",),
    ),
)

RARE = 24  # words that the index keeps of a template, at most
BAND = 16  # words by which postings of one match may be out of step
MIN_SCORE = 0.6


def words_of(text: Column) -> Column:
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(folded, F.lit(WORD), F.lit(0))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def template_words(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(``template``, ``label``, ``at``, ``word``) of all templates."""
    values = ", ".join(f"({i}, {_quoted(label)}, {_quoted(text)})" for i, (label, text, _) in enumerate(templates))
    listed = spark.sql(f"SELECT * FROM VALUES {values} AS t(template, label, text)")
    return listed.select("template", "label", F.posexplode(words_of(F.col("text"))).alias("at", "word"))


def rare_index(docs: DataFrame, text_col: str = "text", templates=TEMPLATES, rare: int = RARE) -> DataFrame:
    """(``word``, ``number``, ``weight``, ``template``, ``label``, ``at``, ``total``): the postings of each template's
    rarest words among all of ``docs``. ``number`` tells words apart, ``total`` is the template's weight."""
    spark = docs.sparkSession
    posted = template_words(spark, templates)
    vocabulary = [r["word"] for r in posted.select("word").distinct().collect()]  # as many as the templates have
    # The empty word stands for the document itself.
    seen = F.array_distinct(F.filter(words_of(F.col(text_col)), lambda w: w.isin(vocabulary)))
    counts = docs.select(F.explode(F.concat(F.array(F.lit("")), seen)).alias("word")).groupBy("word").count()
    counts = stored(counts, "licence-counts")
    n = counts.filter("word = ''").agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    known = posted.join(F.broadcast(counts.filter("word <> ''")), "word", "left")
    df = F.coalesce(F.col("count"), F.lit(0))
    rarity = F.round(F.log((F.lit(n) + 1) / (df + 1)) * 1000).cast("long") + 1
    in_template = Window.partitionBy("template")
    by_rarity = in_template.orderBy(df, "word")
    ranked = known.withColumn("weight", rarity).withColumn("place", F.dense_rank().over(by_rarity))
    distinct = F.max("place").over(in_template)
    ranked = ranked.withColumn("kept", F.least(F.lit(rare), F.ceil(distinct / 2))).filter("place <= kept")
    total = F.sum(F.when(F.col("first"), F.col("weight"))).over(in_template)
    first = F.row_number().over(Window.partitionBy("template", "word").orderBy("at")) == 1
    number = F.dense_rank().over(Window.orderBy("word"))  # of the index's words, some hundreds at most
    index = ranked.withColumn("first", first).withColumn("total", total).withColumn("number", number)
    return stored(index.select("word", "number", "weight", "template", "label", "at", "total"), "licence-index")


def _starts(phrases) -> Column:
    """(``label``, ``at``) of each place of a phrase in the column ``words``, by the phrase's last word."""

    def found(w, i):
        out = F.lit(None).cast("struct<label:string,at:bigint>")
        for label, phrase in phrases:
            parts = phrase.split()
            here = w == parts[-1]
            for back, part in enumerate(reversed(parts[:-1]), 1):
                here = here & (F.get(F.col("words"), i - back) == part)
            place = F.struct(F.lit(label).alias("label"), (i - (len(parts) - 1)).cast("long").alias("at"))
            out = F.when(here, place).otherwise(out)
        return out

    return F.filter(F.transform("words", found), lambda x: x.isNotNull())


def scan(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates=TEMPLATES,
    base=BASE_PHRASES,
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``base`` (label and start of each phrase, in order) and ``matches``
    (``label``, ``template``, ``start``, ``score`` of each template found, best first)."""
    index = rare_index(docs, text_col, templates)
    numbers = {r["word"]: r["number"] for r in index.select("word", "number").distinct().collect()}
    listed = F.array(*[F.lit(w) for w in sorted(numbers, key=numbers.get)]) if numbers else F.array().cast("array<string>")
    phrases = sorted({p for _, _, keys in templates for p in keys})
    worded = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"))
    rare = F.filter(
        F.transform("words", lambda w, i: F.when(w.isin(list(numbers)), F.struct(w.alias("word"), i.alias("at")))),
        lambda x: x.isNotNull(),
    )
    spaced = F.concat(F.lit(" "), F.concat_ws(" ", "words"), F.lit(" "))
    held = F.array_compact(F.array(*[F.when(F.contains("spaced", F.lit(f" {p} ")), F.lit(p)) for p in phrases]))
    # A row id makes rows that repeat an id documents of their own; the written table fixes it.
    looked = worded.select("id", "words", rare.alias("rare")).select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        F.size("words").cast("long").alias("n_words"),
        _starts(base).alias("base"),
        F.transform("rare", lambda x: F.struct(F.array_position(listed, x["word"]).alias("number"), x["at"])).alias("rare"),
        F.when(F.size("rare") > 1, spaced).alias("spaced"),
    )
    looked = stored(looked.withColumn("held", F.coalesce(held, F.array().cast("array<string>"))).drop("spaced"), "licence-words")

    met = looked.filter(F.size("rare") > 1).select("row", F.inline("rare"))
    postings = F.broadcast(index.select("number", "weight", "template", "label", F.col("at").alias("own"), "total"))
    start = F.col("at") - F.col("own")
    bands = F.array(*[F.struct(F.lit(k).alias("set"), F.floor((start + k) / BAND).alias("band")) for k in (0, BAND // 2)])
    pairs = met.join(postings, "number").select("row", "template", "label", "number", "weight", "total", start.alias("start"), F.inline(bands))
    once = pairs.groupBy("row", "template", "label", "total", "set", "band", "number", "weight").agg(F.min("start").alias("start"))
    aligned = once.groupBy("row", "template", "label", "total", "set", "band").agg(
        F.sum("weight").alias("weight"), F.min("start").alias("start")
    )
    best = aligned.groupBy("row", "template", "label", "total").agg(
        F.max(F.struct("weight", (-F.col("start")).alias("early"))).alias("best")
    )
    score = F.col("best.weight") / F.col("total")
    needed = F.array(*[F.array(*[F.lit(p) for p in keys]) for _, _, keys in templates])
    found = best.withColumn("score", score).filter(F.col("score") >= min_score).join(looked.select("row", "held"), "row")
    found = found.filter(F.size(F.array_except(F.get(needed, F.col("template")), "held")) == 0)
    match = F.struct(F.col("score"), "label", "template", (-F.col("best.early")).alias("start"))
    found = found.groupBy("row").agg(F.sort_array(F.collect_list(match), asc=False).alias("matches"))  # one a template
    return looked.join(found, "row", "left").select(
        F.col("id").alias(id_col),
        "n_words",
        "base",
        F.coalesce("matches", F.array().cast("array<struct<score:double,label:string,template:int,start:int>>")).alias("matches"),
    )
