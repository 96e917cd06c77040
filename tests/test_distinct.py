import random

from pyspark.sql import functions as F

from retailstream.operators import distinct


def _case(spark, seed=1):
    rnd = random.Random(seed)
    rows = [(f"d{rnd.randrange(5)}", rnd.choice("xyz"), rnd.randrange(-50, 70_000)) for _ in range(3000)]
    # one dense window: a bucket of more ids than an array holds
    rows += [("d0", "x", i) for i in range(5000)] * 2
    rows += [(None, "x", 1), ("d1", None, 1), ("d1", "x", None)]
    return rows, spark.createDataFrame(rows, "day string, k string, id long")


def _exact(rows, key):
    seen = {}
    for day, k, i in rows:
        if None not in (day, k, i):
            seen.setdefault(key(day, k), set()).add(i)
    return {k: len(v) for k, v in seen.items()}


def test_counts_of_windows_and_of_their_unions(spark):
    rows, df = _case(spark)
    parts = distinct.containers(df, ["day", "k"], "id").cache()
    own = {(r["day"], r["k"]): r["n"] for r in distinct.count(parts, ["day", "k"]).collect()}
    assert own == _exact(rows, lambda d, k: (d, k))
    # both forms occur, and each row has one of them
    forms = {r[0]: r[1] for r in parts.groupBy(F.col("bits").isNull().alias("few")).count().collect()}
    assert set(forms) == {True, False}
    assert parts.where("(bits IS NULL) = (ids IS NULL)").count() == 0
    assert parts.agg(F.max(F.length("bits")), F.max(F.size("ids"))).first()[0] == 4096
    for by, key in ((["day"], lambda d, k: (d,)), (["k"], lambda d, k: (k,))):
        got = {tuple(r[c] for c in by): r["n"] for r in distinct.count(distinct.merge(parts, by), by).collect()}
        assert got == _exact(rows, key)


def test_merging_in_steps_changes_nothing(spark):
    rows, df = _case(spark, 2)
    first = distinct.containers(df.where("day <= 'd1'"), ["day", "k"], "id")
    later = distinct.containers(df.where("day > 'd1'"), ["day", "k"], "id")
    halves = distinct.merge(first, ["k"]).unionByName(distinct.merge(later, ["k"]))
    got = {(r["k"],): r["n"] for r in distinct.count(distinct.merge(halves, ["k"]), ["k"]).collect()}
    assert got == _exact(rows, lambda d, k: (k,))


def test_empty(spark):
    df = spark.createDataFrame([], "day string, id long")
    parts = distinct.containers(df, ["day"], "id")
    assert distinct.count(distinct.merge(parts, ["day"]), ["day"]).count() == 0
