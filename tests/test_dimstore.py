"""The dimension store against the one-shot merge: any batches, any order, replays, compaction."""

import os
import random

from pyspark.sql import functions as F

from retailstream.operators import cdc
from retailstream.sources import dimstore

SCHEMA = "id string, name string, nation string, seq long, type string, _present array<string>"
ALL = ["id", "name", "nation"]


def files_of(path, no):
    top = f"{path}/data/run={no}"
    return [f"{d}/{f}" for d, _, names in os.walk(top) for f in names if f.endswith(".parquet")]


def rows_of(df):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def random_changes(n, seed=1):
    rng, out = random.Random(seed), []
    for seq in range(n):
        key = "hot" if rng.random() < 0.4 else str(rng.randrange(30))
        kind = rng.choice(["insert", "update", "update", "delete"])
        there = [] if kind == "delete" else ["id", *rng.sample(["name", "nation"], rng.randrange(3))]
        out.append((key, f"n{seq}" if "name" in there else None, f"c{seq}" if "nation" in there else None, seq, kind, there))
    return out


def test_batches_in_any_order_equal_one_merge(spark, tmp_dir):
    changes = random_changes(300)
    want = rows_of(cdc.upsert_dimension(None, spark.createDataFrame(changes, SCHEMA)))
    random.Random(4).shuffle(changes)
    path = f"{tmp_dir}/dim"
    dimstore.create(spark, path, ALL, n_buckets=4)
    for i in range(0, 300, 100):
        batch = spark.createDataFrame(changes[i:i + 100], SCHEMA)
        no = dimstore.apply(spark, batch, path, token=f"q:{i}")
        assert dimstore.apply(spark, batch, path, token=f"q:{i}") == no   # a replay adds nothing
        if i == 100:
            before = rows_of(dimstore.read(spark, path))
            assert dimstore.compact(spark, path, least_runs=2) == no + 1
            assert dimstore.compact(spark, path, least_runs=2) is None
            assert rows_of(dimstore.read(spark, path)) == before
    assert rows_of(dimstore.read(spark, path)) == want
    dimstore.compact(spark, path, least_runs=2)
    assert dimstore.drop_replaced(spark, path) > 0 and dimstore.drop_replaced(spark, path) == 0
    assert rows_of(dimstore.read(spark, path)) == want
    # merged buckets are read without a shuffle
    assert "Exchange" not in dimstore.read(spark, path)._jdf.queryExecution().executedPlan().toString()


def test_a_batch_writes_the_buckets_of_its_keys_only(spark, tmp_dir):
    path = f"{tmp_dir}/dim"
    dimstore.create(spark, path, ALL, n_buckets=64)
    many = [(str(i), "a", "b", i, "insert", ALL) for i in range(2000)]
    dimstore.apply(spark, spark.createDataFrame(many, SCHEMA), path)
    few = [("7", "x", None, 5000, "update", ["id", "name"]), ("8", "y", None, 5001, "update", ["id", "name"]),
           ("7", "z", None, 5002, "update", ["id", "name"])]
    no = dimstore.apply(spark, spark.createDataFrame(few, SCHEMA), path)
    assert 1 <= len(files_of(path, no)) <= 2
    got = {r["id"]: (r["name"], r["nation"]) for r in dimstore.read(spark, path, keys=["7", "8", "9", "none"]).collect()}
    assert got == {"7": ("z", "b"), "8": ("y", "b"), "9": ("a", "b")}
    # an earlier version is still there
    assert dimstore.read(spark, path, version=no - 1).where("id = '7'").first()["name"] == "a"


def test_a_broken_off_batch_is_not_seen(spark, tmp_dir):
    path = f"{tmp_dir}/dim"
    dimstore.create(spark, path, ALL)
    first = spark.createDataFrame([("1", "a", "b", 1, "insert", ALL)], SCHEMA)
    dimstore.apply(spark, first, path, "q:0")
    half = spark.createDataFrame([("2", "a", "b", 2, "insert", ALL)], SCHEMA)
    cdc.fold_changes(half).withColumn("key_bucket", F.lit(3)).write.partitionBy("key_bucket").parquet(f"{path}/data/run=2")
    assert [r["id"] for r in dimstore.read(spark, path).collect()] == ["1"]
    assert dimstore.apply(spark, half, path, "q:1") == 2   # written anew, over what was left
    assert sorted(r["id"] for r in dimstore.read(spark, path).collect()) == ["1", "2"]


def test_columns_are_added_and_empty_batches_are_runs(spark, tmp_dir):
    path = f"{tmp_dir}/dim"
    dimstore.create(spark, path, ["id", "name"])
    assert dimstore.read(spark, path).columns == ["id", "name", "seq"] and dimstore.read(spark, path).count() == 0
    none = spark.createDataFrame([], SCHEMA)
    assert dimstore.apply(spark, none, path, "q:0") == 1
    more = spark.createDataFrame([("1", "a", "b", 1, "insert", ALL), (None, "x", "y", 2, "insert", ALL)], SCHEMA)
    dimstore.apply(spark, more, path, "q:1")
    old = spark.createDataFrame([("2", "c", 3, "insert")], "id string, name string, seq long, type string")
    dimstore.apply(spark, old, path, "q:2")
    assert {tuple(r) for r in dimstore.read(spark, path).select("id", "name", "nation").collect()} == {
        ("1", "a", "b"), ("2", "c", None)}
