"""License scans [native]: word k-grams vote for offset diagonals of license templates.

A template is a phrase (its words must stand consecutively) or a notice (most of
its words must, with words put in, left out or changed).  All rolling word
k-grams of a text are hashed and joined to the positions of the templates'
k-grams.  A gram at word ``at`` of the text and ``tat`` of the template votes for
the diagonal ``at - tat``; votes are counted by (text, template, diagonal).  A
phrase stands where a diagonal has all its votes.  A notice's neighbouring
diagonals, apart by at most ``max_shift`` words, are merged into a span, and the
span is verified by the share of the template's words that its grams cover.
Grams are compared word by word behind the hash, so no collision counts.

Texts are known by their SHA-256: copies vote once (votes are sets), and the
verdict of a text goes back to all its rows.  Texts never shuffle: votes and
digests do.  The templates are a parameter, and their grams are broadcast only
while they are at most ``MAX_BROADCAST_GRAMS``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailstream.llm.common import stored
from retailstream.llm.url_filter import ascii_lower

GRAM = {"phrase": 2, "notice": 4}    # words of a gram, by kind of template
MAX_SHIFT = 8                        # words between diagonals that are merged
MIN_COVER = 0.8                      # share of a notice's words that a span must cover
MAX_BROADCAST_GRAMS = 200_000
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"            # in lower-cased text
BETWEEN_RAW = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"       # in text as it is

# fixed values: phrases of the contract, and public license notices
PHRASES = [("mit", "phrase", "mit license"), ("apache", "phrase", "apache license"),
           ("gpl", "phrase", "general public license")]
NOTICES = [
    ("mit", "notice", "Released under the MIT License."),
    ("mit", "notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
     "and associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
     "of the Software"),
    ("apache-2.0", "notice", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "notice", "Unless required by applicable law or agreed to in writing, software distributed under "
     "the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
     "or implied."),
    ("gpl-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "notice", "This program is free software: you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "notice", "under the terms of the GNU Lesser General Public License"),
    ("bsd", "notice", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met"),
    ("isc", "notice", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted"),
    ("mpl-2.0", "notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc-4.0", "notice", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "notice", "Licensed under CC BY-SA 4.0."),
    ("cc-by-4.0", "notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("unlicense", "notice", "This is free and unencumbered software released into the public domain."),
    ("reserved", "notice", "No part of this publication may be reproduced without prior written permission"),
]
TEMPLATES = PHRASES + NOTICES


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), BETWEEN_WORDS), "")


def text_grams(texts: DataFrame, gram_sizes: Sequence[int]) -> DataFrame:
    """``key, at, k, h, w0, w1, ..``: size, hash and words of all rolling grams of ``key, text``.

    A text's words are zipped with themselves, shifted by one word and more, so
    that every row of the exploded text has the words that follow.
    """
    longest = max(gram_sizes)
    words = texts.select("key", words_of(F.col("text")).alias("w"))
    shifted = [F.slice("w", j + 1, F.greatest(F.size("w") - j, F.lit(0))).alias(f"w{j}") for j in range(longest)]
    rows = words.select("key", F.posexplode(F.arrays_zip(*shifted)).alias("at", "z"))
    own = [F.col(f"z.w{j}").alias(f"w{j}") for j in range(longest)]
    sized = [F.struct(F.lit(k).alias("k"), F.when(F.col(f"w{k - 1}").isNotNull(), F.xxhash64(
        F.lit(k), *[F.col(f"w{j}") for j in range(k)])).alias("h")) for k in gram_sizes]
    grams = rows.select("key", F.col("at").cast("long").alias("at"), *own)
    grams = grams.select("*", F.explode(F.array(*sized)).alias("g"))
    return grams.select("key", "at", "g.k", "g.h", *[f"w{j}" for j in range(longest)]).where("h IS NOT NULL")


def template_grams(spark: SparkSession, templates: Sequence[tuple[str, str, str]]) -> tuple[DataFrame, DataFrame]:
    """(``tpl, label, kind, k, n`` of each template, ``h, k, tpl, tat, t0, t1, ..`` of its grams)."""
    rows = [(i, label, kind, GRAM[kind], text) for i, (label, kind, text) in enumerate(templates)]
    named = spark.createDataFrame(rows, "tpl int, label string, kind string, k int, text string")
    named = named.select("tpl", "label", "kind", "k", F.size(words_of(F.col("text"))).alias("n"), "text")
    sizes = sorted({r[3] for r in rows})
    grams = text_grams(named.select(F.col("tpl").alias("key"), "text"), sizes)
    grams = grams.select("h", "k", F.col("key").alias("tpl"), F.col("at").alias("tat"),
                         *[F.col(f"w{j}").alias(f"t{j}") for j in range(max(sizes))])
    return named.drop("text"), grams.join(named.select("tpl", "k"), ["tpl", "k"], "left_semi")


def diagonals(texts: DataFrame, templates: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``key, tpl, diagonal, votes, first, last``: template positions that voted, and their first and last word
    in the text, for each diagonal with a vote."""
    _, theirs = template_grams(texts.sparkSession, templates)
    if sum(len(text) for _, _, text in templates) <= MAX_BROADCAST_GRAMS:   # fewer grams than characters
        theirs = F.broadcast(theirs)
    sizes = sorted({GRAM[kind] for _, kind, _ in templates})
    own = text_grams(texts, sizes)
    same = (own["h"] == theirs["h"]) & (own["k"] == theirs["k"])
    for j in range(max(sizes)):   # the words themselves, behind the hash
        same = same & ((own["k"] <= j) | (own[f"w{j}"] == theirs[f"t{j}"]))
    met = own.join(theirs, same).select("key", "tpl", "at", "tat")
    return (met.groupBy("key", "tpl", (F.col("at") - F.col("tat")).alias("diagonal"))
            .agg(F.collect_set("tat").alias("votes"), F.min("at").alias("first"), F.max("at").alias("last")))


def _covered(votes: Column, k: Column) -> Column:
    """Template words that grams of ``k`` words at the (sorted) positions ``votes`` cover."""
    steps = F.transform(votes, lambda a, i: F.least(F.coalesce(F.get(votes, i + 1) - a, k), k))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)


def spans(texts: DataFrame, templates: Sequence[tuple[str, str, str]] = TEMPLATES, max_shift: int = MAX_SHIFT,
          min_cover: float = MIN_COVER) -> DataFrame:
    """``key, label, kind, start, end, cover, verified``: where a template's words were found in ``key, text``.

    ``start`` and ``end`` count words (end excluded); ``cover`` is the share of the
    template's words.  Phrases are listed where all of their words stand; notices
    wherever a gram of theirs does, verified from ``min_cover`` on.
    """
    named, _ = template_grams(texts.sparkSession, templates)
    found = stored(diagonals(texts, templates), "license-diagonals").join(F.broadcast(named), "tpl")
    phrases = found.where("kind = 'phrase' AND size(votes) = n - k + 1").select(
        "key", "label", "kind", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("n")).alias("end"),
        F.lit(1.0).alias("cover"), F.lit(True).alias("verified"))
    along = Window.partitionBy("key", "tpl").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > max_shift, F.lit(True))
    islands = (found.where("kind = 'notice'").withColumn("apart", apart.cast("int"))
               .withColumn("island", F.sum("apart").over(along)))
    merged = islands.groupBy("key", "tpl", "label", "kind", "k", "n", "island").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("votes")))).alias("votes"),
        F.min("first").alias("start"), (F.max("last") + F.col("k")).alias("end"))
    cover = F.round(_covered(F.col("votes"), F.col("k").cast("long")) / F.col("n"), 6)
    notices = merged.select("key", "label", "kind", "start", "end", cover.alias("cover")).withColumn(
        "verified", F.col("cover") >= min_cover)
    return phrases.unionByName(notices)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: Sequence[tuple[str, str, str]] = TEMPLATES, max_shift: int = MAX_SHIFT,
                  min_cover: float = MIN_COVER) -> DataFrame:
    """Per row of ``docs``: ``{id_col}, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts the places of all phrases, ``first_word`` and ``last_word``
    are the least and largest word that one begins at (null without any);
    ``base_labels`` are the labels of the phrases found, ``labels`` those and the
    labels of the verified notices, distinct, sorted, comma-joined (empty: none).
    ``score``: the largest cover of any template, 0 to 1.

    ``templates``: (label, kind, text); a phrase needs two words, a notice four.
    A null text is empty.  Repeated rows, repeated and null ids are judged row by
    row.  Other columns are ignored, whatever their names.  An empty table gives
    no rows.
    """
    for _, kind, text in templates:
        if len(text.split()) < GRAM[kind]:
            raise ValueError(f"a {kind} of fewer than {GRAM[kind]} words: {text!r}")
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(text, 256))
    found = spans(docs.select(digest.alias("key"), text.alias("text")), templates, max_shift, min_cover)
    base = F.col("kind") == "phrase"

    def joined(which: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(F.when(which, F.col("label")))), ",")
    by_text = stored(found.groupBy("key").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"), joined(base).alias("base_labels"),
        joined(F.col("verified")).alias("labels"), F.max("cover").alias("score")), "license-verdicts")
    rows = docs.select(F.col(id_col).alias("id"), digest.alias("key"),
                       F.size(F.array_remove(F.split(text, BETWEEN_RAW), "")).cast("long").alias("n_words"))
    return rows.join(by_text, "key", "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
