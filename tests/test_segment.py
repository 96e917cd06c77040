import random

from pyspark.sql import functions as F

from retailstream.operators import segment


def _brute(run, words):
    longest = max(map(len, words), default=0)
    out, free, at = [], 0, 0
    while at < len(run):
        n = next((k for k in range(min(longest, len(run) - at), 0, -1) if run[at:at + k] in words), 0)
        if not n:
            at += 1
            continue
        if at > free:
            out.append((run[free:at], False))
        out.append((run[at:at + n], True))
        at = free = at + n
    return out + ([(run[free:], False)] if free < len(run) else [])


def _cut(spark, runs, words, **kw):
    r = spark.createDataFrame([(x,) for x in runs], "run string")
    d = spark.createDataFrame([(w,) for w in words], "word string")
    return {x["run"]: [(w["word"], w["known"]) for w in x["words"]] for x in segment.segment_runs(r, d, **kw).collect()}


def test_longest_word_first_and_rest_together(spark):
    words = ["苹果", "苹果手机", "手机", "手机壳", "红色"]
    runs = ["苹果手机壳", "红色苹果手机壳", "买红色的", "没有", "苹果苹果", None, "", "苹果苹果"]
    got = _cut(spark, runs, words)
    assert got["苹果手机壳"] == [("苹果手机", True), ("壳", False)]     # the longer word takes the shared characters
    assert got["红色苹果手机壳"] == [("红色", True), ("苹果手机", True), ("壳", False)]
    assert got["买红色的"] == [("买", False), ("红色", True), ("的", False)]
    assert got["没有"] == [("没有", False)]
    assert got["苹果苹果"] == [("苹果", True), ("苹果", True)]
    assert len(got) == 5                                          # null and empty runs have no words


def test_brute_force_with_overlaps_and_long_runs(spark):
    rnd = random.Random(4)
    text = lambda n: "".join(rnd.choice("abc𠀀é") for _ in range(n))
    words = {text(rnd.randrange(1, 7)) for _ in range(150)} - {"a", "b", "c", "𠀀", "é"}
    runs = {text(rnd.randrange(1, 40)) for _ in range(200)} | {text(255), text(256), text(257), text(513), text(5000), "ab" * 3000}
    got = _cut(spark, sorted(runs), sorted(words) + [w.upper() for w in words] + [None, ""])
    assert got == {r: _brute(r, words) for r in runs}


def test_empty_dictionary_and_long_words(spark):
    assert _cut(spark, ["ab"], []) == {"ab": [("ab", False)]}
    assert _cut(spark, ["abcd"], ["abc", "b"], max_len=2) == {"abcd": [("a", False), ("b", True), ("cd", False)]}


def test_rows_keep_their_columns_and_repeats(spark):
    rows = spark.createDataFrame([("红色手机 ABC", 1), ("红色手机", 2), ("红色手机", 2), (None, 3), ("", 4)], "full_word string, ts long")
    d = spark.createDataFrame([("手机",), ("手机",)], "word string")
    got = sorted(map(tuple, segment.dictionary_keywords(rows, d).select("ts", "keyword", "known").collect()))
    assert got == [(1, "abc", False), (1, "手机", True), (1, "红色", False), (2, "手机", True), (2, "手机", True),
                   (2, "红色", False), (2, "红色", False)]
    joined = segment.segment_runs(rows.select(F.col("full_word").alias("run")), d)
    assert joined.where("array_join(transform(words, w -> w.word), '') != run").count() == 0
