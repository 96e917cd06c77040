import random

import pytest
from pyspark.sql import functions as F

from retailstream.operators import patterns, visits
from retailstream.operators.patterns import Step
from retailstream.streaming.patterns import outcomes_stream
from tests.conftest import page_rows

T0 = 1_704_067_200_000
W = 5_000


def _rows(n, hot=0.4, keys=12, span=400_000, seed=3):
    rnd = random.Random(seed)
    return [("hot" if rnd.random() < hot else f"k{rnd.randrange(keys)}", T0 + rnd.randrange(span), s, rnd.choice("abcd"))
            for s in range(n)]


def _brute(rows, wanted, strict, within):
    """Literal walk of every start over all rows of its key."""
    by, out = {}, {}
    for r in sorted(rows, key=lambda r: r[1:3]):
        by.setdefault(r[0], []).append(r)
    for rs in by.values():
        for i, s in enumerate(rs):
            if s[3] != wanted[0]:
                continue
            met, verdict, decided = [s[2]], None, None
            if len(wanted) == 1:
                verdict, decided = "match", s[1]
            for r in rs[i + 1:]:
                if verdict or r[1] - s[1] >= within:
                    break
                if r[3] == wanted[len(met)]:
                    met.append(r[2])
                    if len(met) == len(wanted):
                        verdict, decided = "match", r[1]
                elif strict[len(met)]:
                    verdict, decided = "broken", r[1]
            out[s[2]] = (verdict or "timeout", decided or s[1] + within, met)
    return out


def kind(name):
    return F.col("kind") == name


def _got(df):
    return {r["seq"]: (r["outcome"], r["decided_at"], [m["seq"] for m in r["met"]]) for r in df.collect()}


def case(name):
    """Steps, the kinds they want, and which of them must be next."""
    return {
        "funnel": lambda: ([Step(kind("a")), Step(kind("b")), Step(kind("c"))], "abc", [False] * 3),
        "next": lambda: ([Step(kind("a")), Step(kind("a"), next=True)], "aa", [False, True]),
        "mixed": lambda: ([Step(kind("a")), Step(kind("b")), Step(kind("b"), next=True), Step(kind("d"))], "abbd",
                          [False, False, True, False]),
        "times": lambda: ([Step(kind("a"), times=3), Step(kind("c"))], "aaac", [False] * 4),
        "single": lambda: ([Step(kind("b"))], "b", [False]),
    }[name]()


@pytest.mark.parametrize("name", ["funnel", "mixed", "next", "single", "times"])
def test_outcomes_match_brute_force_with_a_hot_key(spark, name):
    steps, wanted, strict = case(name)
    rows = _rows(1200)
    df = spark.createDataFrame(rows, "k string, ts long, seq long, kind string")
    got = _got(patterns.outcomes(df, steps, F.col("k"), W, broken=True))
    assert got == _brute(rows, wanted, strict, W)
    # longer buckets, and negative times, change nothing
    moved = df.withColumn("ts", F.col("ts") - 2 * T0)
    far = _got(patterns.outcomes(moved, steps, F.col("k"), W, bucket_ms=60_000, broken=True))
    assert {s: (o, d + 2 * T0, m) for s, (o, d, m) in far.items()} == got


def test_awkward_rows(spark):
    df = spark.createDataFrame([(None, T0, 1, "a"), ("k", None, 2, "a"), ("k", T0, 3, "a"), ("k", T0 + W, 4, "b"),
                                ("k", T0 + 1, 5, None), ("z", T0, 6, "b")], "k string, ts long, seq long, kind string")
    steps = [Step(kind("a")), Step(kind("b"))]
    # a row exactly at the end of the time is too late, a null kind meets nothing
    assert _got(patterns.outcomes(df, steps, F.col("k"), W)) == {3: ("timeout", T0 + W, [3])}
    assert patterns.outcomes(df.limit(0), steps, F.col("k"), W).count() == 0
    with pytest.raises(ValueError):
        patterns.outcomes(df, [], F.col("k"), W)
    with pytest.raises(ValueError):
        patterns.outcomes(df, steps, F.col("k"), 0)


def test_bounce_is_a_pattern_of_two_entries(spark):
    rnd = random.Random(5)
    log = page_rows(spark, [(s, T0 + rnd.randrange(300_000), f"m{rnd.randrange(6)}", "0", rnd.choice([None, "home"]))
                            for s in range(300)])
    entry = F.col("page.last_page_id").isNull()
    out = patterns.outcomes(log, [Step(entry), Step(entry, next=True)], F.col("common.mid"), 10_000)
    cols = ["seq", "outcome", "decided_at"]
    want = visits.bounce_outcomes(log, within_ms=10_000)
    assert sorted(map(tuple, out.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_one_shuffle_whatever_the_steps(spark):
    steps, _, _ = case("mixed")
    df = spark.createDataFrame(_rows(20), "k string, ts long, seq long, kind string")
    plan = patterns.outcomes(df, steps, F.col("k"), W)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["funnel", "mixed"])
def test_stream_equals_batch(spark, tmp_dir, name):
    steps, wanted, strict = case(name)
    rows = sorted(_rows(240, span=120_000, seed=9), key=lambda r: r[1:3])
    schema = "k string, ts long, seq long, kind string"
    closing = [("end", T0 + 10_000_000, 10_000, "d"), ("end", T0 + 20_000_000, 10_001, "d")]
    parts = [rows[:100], rows[100:170], rows[170:], closing[:1], closing[1:]]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.json(f"{tmp_dir}/in/{i}")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_dir}/in/*")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        q = (outcomes_stream(src, steps, F.col("k"), W).writeStream.format("parquet")
             .option("checkpointLocation", f"{tmp_dir}/cp").start(f"{tmp_dir}/out"))
        q.processAllAvailable()
        q.stop()
    finally:
        spark.conf.set(provider, before) if before else spark.conf.unset(provider)
    want = {s: v for s, v in _brute(rows, wanted, strict, W).items() if v[0] != "broken"}
    assert _got(spark.read.parquet(f"{tmp_dir}/out").where("key != 'end'")) == want
