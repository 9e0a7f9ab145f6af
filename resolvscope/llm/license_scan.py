"""License passages in documents, found by voting for diagonals of equal word grams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from resolvscope.llm.text import ascii_words, digest

GRAM = 5


@dataclass(frozen=True)
class Template:
    """A text to find. Short ones (under 8 words) must stand word for word and vote with grams of two words."""

    label: str
    text: str
    base: bool = False


# The phrases that always count.
PHRASES = [
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
]

# Notices and licence texts as their owners publish them.
TEXTS = [
    Template("reserved", "all rights reserved"),
    Template("spdx-apache", "spdx license identifier apache 2 0"),
    Template("spdx-mit", "spdx license identifier mit"),
    Template("mit-notice", "released under the mit license"),
    Template("apache-notice", "licensed under the apache license version 2 0"),
    Template("gpl-notice", "is licensed under the gnu general public license version 3"),
    Template(
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        'SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    Template(
        "apache-header",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    Template(
        "gpl-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details.",
    ),
    Template(
        "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
    ),
    Template(
        "isc-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
]

_WORDS = [f"w{i}" for i in range(GRAM)]


def _grams(words: Column) -> Column:
    """Array of structs of the words from each position on, null beyond the end."""
    shifted = [words] + [F.slice(words, F.lit(i + 1), F.size(words)) for i in range(1, GRAM)]
    return F.arrays_zip(*[s.alias(n) for s, n in zip(shifted, _WORDS, strict=True)])


def _template_grams(spark: SparkSession, templates: list[Template]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), F.lit(t.text).alias("text")) for t in templates])
    return (
        spark.range(1)
        .select(F.explode(rows).alias("t"))
        .select("t.label", "t.base", ascii_words(F.col("t.text")).alias("words"))
        .withColumn("t_words", F.size("words"))
        .withColumn("k", F.when(F.col("t_words") < 8, 2).otherwise(GRAM))
        .select("label", "base", "t_words", "k", F.posexplode(_grams(F.col("words"))).alias("t_pos", "g"))
        .where(F.col("t_pos") <= F.col("t_words") - F.col("k"))
        .select("label", "base", "t_words", "k", "t_pos", F.xxhash64("g.w0", "g.w1").alias("t_hash"), *[F.col(f"g.{n}").alias(f"t_{n}") for n in _WORDS])
    )


def scan(documents: DataFrame, templates: list[Template] | None = None, gap: int = 8, coverage: float = 0.5) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``score`` and ``spans``, an array of (label, base, first_word, last_word, coverage).

    Every word position joins the template positions whose gram starts with the same two words (broadcast: the templates are
    a parameter, not data). Equal grams vote for the diagonal ``position - template position``. Diagonals of one template
    that are at most ``gap`` words apart are merged, so that a passage with inserted or missing words stays one; one that
    repeats over half the template positions of the one before it, or of which over half stand there, is a further copy and
    starts anew. A merged diagonal is verified: a short template needs all its grams on one diagonal, a long one the share ``coverage`` of its grams
    within twice its length. ``score`` is the best share of any template, 1 for a whole one.

    Null and empty texts have no words, no spans and score 0. Rows with a null id are told apart by their text; repeated
    rows are returned as often as they come. Columns other than ``doc_id`` and ``text`` are ignored.
    """
    spark = documents.sparkSession
    grams = _template_grams(spark, PHRASES + TEXTS if templates is None else templates)
    places = (
        documents.select("doc_id", digest(F.col("text")).alias("digest"), ascii_words(F.col("text")).alias("words"))
        .select("doc_id", "digest", F.size("words").cast("long").alias("n_words"), _grams(F.col("words")).alias("grams"))
        .select("doc_id", "digest", "n_words", F.posexplode_outer("grams").alias("pos", "g"))
        .select("doc_id", "digest", "n_words", "pos", F.xxhash64("g.w0", "g.w1").alias("hash"), *[F.col(f"g.{n}").alias(n) for n in _WORDS])
    )
    same = (F.col("hash") == F.col("t_hash")) & (F.col("w0") == F.col("t_w0")) & (F.col("w1") == F.col("t_w1"))
    rest = F.lit(True)
    for n in _WORDS[2:]:
        rest = rest & (F.col(n) == F.col(f"t_{n}"))
    # The first position of each document stays even without a vote and stands for the document.
    votes = (
        places.join(F.broadcast(grams), same & ((F.col("k") == 2) | rest), "left")
        .where(F.col("label").isNotNull() | (F.coalesce("pos", F.lit(0)) == 0))
        .withColumn("diagonal", F.col("pos") - F.col("t_pos"))
    )
    document = ["doc_id", "digest", "n_words"]
    template = ["label", "base", "t_words", "k"]
    is_first = F.coalesce("pos", F.lit(0)) == 0
    by_place = votes.groupBy(*document, *template, "diagonal", "t_pos").agg(F.count(F.when(is_first, 1)).alias("copies"))
    by_diagonal = by_place.groupBy(*document, *template, "diagonal").agg(
        F.count("t_pos").alias("votes"), F.min("t_pos").alias("low"), F.max("t_pos").alias("high"), F.max("copies").alias("copies"),
        F.collect_set("t_pos").alias("places"),
    )
    order = Window.partitionBy(*document, *template).orderBy("diagonal")
    before = F.lag("places").over(order)
    again = 2 * F.size(F.array_intersect("places", before)) > F.least(F.size("places"), F.size(before))
    apart = again | (F.col("diagonal") - F.lag("diagonal").over(order) > F.when(F.col("k") == 2, 0).otherwise(gap))
    merged = (
        by_diagonal.withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int"))
        .withColumn("run", F.sum("apart").over(order))
        .groupBy(*document, *template, "run")
        .agg(
            F.sum("votes").alias("votes"),
            F.min(F.col("diagonal") + F.col("low")).cast("long").alias("first_word"),
            F.max(F.col("diagonal") + F.col("high") + F.col("k") - 1).cast("long").alias("last_word"),
            F.max("copies").alias("copies"),
        )
        .withColumn("coverage", F.when(F.col("label").isNull(), 0.0).otherwise(F.least(F.lit(1.0), F.col("votes") / (F.col("t_words") - F.col("k") + 1))))
    )
    short = F.col("k") == 2
    fits = F.when(short, F.col("coverage") == 1.0).otherwise(
        (F.col("coverage") >= coverage) & (F.col("last_word") - F.col("first_word") < 2 * F.col("t_words"))
    )
    return (
        merged.groupBy(*document)
        .agg(
            F.max("coverage").alias("score"),
            F.sort_array(
                F.collect_list(F.when(F.col("label").isNotNull() & fits, F.struct("label", "base", "first_word", "last_word", "coverage")))
            ).alias("spans"),
            F.max("copies").alias("copies"),
        )
        .select("doc_id", "n_words", "score", "spans", F.explode(F.expr("sequence(1L, copies)")).alias("copy"))
        .drop("copy")
    )


def summarise(found: DataFrame) -> DataFrame:
    """Base places and labels of ``scan``'s rows as plain columns."""
    base = F.filter("spans", lambda s: s["base"])
    labels = lambda spans: F.array_join(F.sort_array(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["first_word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda s: s["first_word"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        "score",
    )
