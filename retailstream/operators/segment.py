"""Words by a user dictionary (UDT-1): longest match over a dictionary table.

Scripts without spaces come as whole runs from ``functions.keywords.tokenize``.  Here
each distinct run is cut at the words of a dictionary: from left to right, the longest
word that starts at a place is taken; characters at which no word starts are kept
together as one word of their own.

The dictionary is a table of any size.  Every place of a run is looked up with one
piece for each *length* that dictionary words have, by a shuffled equi-join: nothing is
broadcast, and the driver gets the lengths alone (at most ``max_len`` numbers).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from retailstream.functions.keywords import tokenize


_WORDS = ArrayType(StructType([StructField("word", StringType()), StructField("known", BooleanType())]))


@F.pandas_udf(_WORDS)
def _cut(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Walk over the matches of a run, (place from 1, length) sorted by place."""
    def one(run: str, found) -> list[dict]:
        words, free = [], 0
        for m in found if found is not None else ():
            at = m["pos"] - 1
            if at < free:
                continue
            if at > free:
                words.append({"word": run[free:at], "known": False})
            free = at + m["len"]
            words.append({"word": run[at:free], "known": True})
        if free < len(run):
            words.append({"word": run[free:], "known": False})
        return words

    for runs, found in parts:
        yield pd.Series([one(r, f) for r, f in zip(runs, found, strict=True)], dtype=object)


def word_list(dictionary: DataFrame, word: str = "word", max_len: int = 64) -> DataFrame:
    """The dictionary as it is matched: distinct, lower-case, 1 to ``max_len`` characters."""
    w = F.lower(F.col(word))
    return dictionary.select(w.alias("word")).where(F.length("word").between(1, max_len)).distinct()


def segment_runs(runs: DataFrame, dictionary: DataFrame, run: str = "run", word: str = "word",
                 max_len: int = 64) -> DataFrame:
    """``{run}, words`` for each distinct non-null run: ``words`` are ``(word, known)`` in order,
    which put together are the run.  Runs are taken as they are (lower-case ones from ``tokenize``)."""
    words = word_list(dictionary, word, max_len)
    lengths = [r[0] for r in words.select(F.length("word")).distinct().collect()]   # at most max_len
    distinct = runs.select(F.col(run).alias("run")).where("run IS NOT NULL AND run != ''").distinct()
    distinct = distinct.withColumn("id", F.sha2("run", 256))
    if not lengths:
        return distinct.select(F.col("run").alias(run), _cut("run", F.array().cast("array<struct<pos int, len int>>")).alias("words"))
    # a long run is cut into blocks, each with the start of the one behind it, and not copied for each of its places
    block = max(256, max_len)
    blocks = distinct.select("id", F.regexp_extract_all("run", F.lit(f"(?s).{{1,{block}}}"), F.lit(0)).alias("b"))
    blocks = blocks.select("id", F.posexplode(F.transform("b", lambda x, i: F.struct(
        x.alias("own"), F.coalesce(F.get("b", i + 1), F.lit("")).alias("behind")))).alias("k", "x")).select(
        "id", (F.col("k") * block).alias("start"), F.length("x.own").alias("n"),
        F.concat("x.own", F.substr("x.behind", F.lit(1), F.lit(max(lengths) - 1))).alias("text"))
    places = blocks.select("id", "start", "text", F.explode(F.sequence(F.lit(1), "n")).alias("i"))
    pieces = (places.withColumn("len", F.explode(F.array(*[F.lit(x) for x in sorted(lengths)])))
              .where("i + len - 1 <= length(text)")
              .select("id", (F.col("start") + F.col("i")).alias("pos"), "len",
                      F.substr("text", "i", "len").alias("word")))
    longest = (pieces.join(words.hint("shuffle_merge"), "word", "left_semi")
               .groupBy("id", "pos").agg(F.max("len").alias("len")))
    found = longest.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "len"))).alias("found"))
    return distinct.join(found, "id", "left").select(F.col("run").alias(run), _cut("run", "found").alias("words"))


def dictionary_keywords(rows: DataFrame, dictionary: DataFrame, text: Column | str = "full_word",
                        word: str = "word", max_len: int = 64) -> DataFrame:
    """As ``stats.explode_keywords``, with runs cut by the dictionary: a row for each word of
    ``text``, with ``keyword`` and ``known`` in place of ``full_word``.  Each distinct run is cut
    once; its rows find the words by a shuffled join, which AQE splits for a frequent run."""
    marked = rows.withColumn("_run", F.explode(tokenize(text)))
    cut = segment_runs(marked.select("_run"), dictionary, "_run", word, max_len)
    return (marked.join(cut, "_run").withColumn("_w", F.explode("words"))
            .select(*[c for c in rows.columns if c != text], F.col("_w.word").alias("keyword"),
                    F.col("_w.known").alias("known")))
