"""ST-1..3 on streams with a visitor that holds two fifths of all rows: same rows as the batch operators."""

import os
import random

import pytest
from pyspark.sql import functions as F

from retailstream.operators import visits
from retailstream.sources import commits, dimstore
from retailstream.streaming import processors as P
from retailstream.streaming import spread

T0 = 1_704_067_200_000
HOUR = 3_600_000
FAR = T0 + 1000 * 24 * HOUR


def flat_row(seq, ts, mid, is_new, last):
    return (seq, ts, mid, "v", "c", "a", is_new, "p", last, None, None, 5, None, None)


def log_rows(n=600, days=4):
    """Rows in order of time, some swapped with a neighbour; 'hot' has two fifths of them."""
    rng = random.Random(3)
    rows, ts = [], T0
    for seq in range(n):
        ts += rng.randrange(1, 2 * days * 24 * HOUR // n)
        mid = "hot" if rng.random() < 0.4 else f"m{rng.randrange(25)}"
        rows.append((ts - rng.choice((0, 0, 900_000)), mid, rng.choice("011"), rng.choice((None, None, "home"))))
    return [flat_row(seq, *r) for seq, r in enumerate(rows)]


def topic(spark, where, parts):
    for i, rows in enumerate(parts):   # a file for each batch, in order
        spark.createDataFrame(rows, P.FLAT_PAGE).coalesce(1).write.mode("append").parquet(where)
        for f in os.listdir(where):
            if f.endswith(".parquet") and not os.path.exists(f"{where}/.seen-{f}"):
                open(f"{where}/.seen-{f}", "w").close()
                os.utime(f"{where}/{f}", (1_700_000_000 + i, 1_700_000_000 + i))
    return lambda: spark.readStream.schema(P.FLAT_PAGE).option("maxFilesPerTrigger", 1).parquet(where)


def cut(rows, *at):
    bounds = [0, *at, len(rows)]
    return [rows[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def read_topic(spark, where):
    got = commits.read_committed(spark, where)
    return got.select(F.from_json("value", P.FLAT_PAGE).alias("r")).select("r.*")


def drain(query):
    query.processAllAvailable()
    query.stop()


@pytest.fixture(scope="module")
def nested(spark):
    flat = spark.createDataFrame(log_rows(), P.FLAT_PAGE)
    return P.nest_page_log(flat, "array<struct<item:string,item_type:string>>")


def test_new_visitors(spark, tmp_dir, nested):
    src = topic(spark, f"{tmp_dir}/in", cut(log_rows(), 150, 400))
    drain(spread.start_new_visitor_repair(src(), f"{tmp_dir}/out", f"{tmp_dir}/state", f"{tmp_dir}/ck"))
    want = visits.repair_new_visitor(nested).select("seq", F.col("common.is_new").alias("is_new"))
    assert sorted(read_topic(spark, f"{tmp_dir}/out").select("seq", "is_new").collect()) == sorted(want.collect())


def test_new_visitors_after_a_snapshot(spark, tmp_dir, nested):
    rows = log_rows()
    src = topic(spark, f"{tmp_dir}/in", cut(rows[300:], 100))
    seen = visits.new_visitors_seen(nested.where("seq < 300"))
    drain(spread.start_new_visitor_repair(src(), f"{tmp_dir}/out", f"{tmp_dir}/state", f"{tmp_dir}/ck", seen=seen))
    want = visits.repair_new_visitor(nested).where("seq >= 300").select("seq", "common.is_new")
    assert sorted(read_topic(spark, f"{tmp_dir}/out").select("seq", "is_new").collect()) == sorted(want.collect())


@pytest.mark.parametrize("bucket_rows", [20, 10_000])
def test_unique_visits_over_a_restart(spark, tmp_dir, nested, bucket_rows):
    parts = cut(log_rows(), 150, 400)

    def run(stream):
        drain(spread.start_unique_visit(stream, f"{tmp_dir}/out", f"{tmp_dir}/state", f"{tmp_dir}/ck", ttl_ms=None,
                                        bucket_rows=bucket_rows))
    run(topic(spark, f"{tmp_dir}/in", parts[:1])())
    run(topic(spark, f"{tmp_dir}/in", parts[1:])())   # same checkpoint, same state
    want = visits.daily_unique_visit(nested).select("seq")
    assert sorted(read_topic(spark, f"{tmp_dir}/out").select("seq").collect()) == sorted(want.collect())


def test_bounces(spark, tmp_dir, nested):
    rows = log_rows()
    end = flat_row(10 ** 6, FAR, "end", "0", "home")
    src = topic(spark, f"{tmp_dir}/in", [*cut(rows, 150, 151, 400), [end]])
    drain(spread.start_user_jump(src(), f"{tmp_dir}/out", f"{tmp_dir}/state", f"{tmp_dir}/ck", within_ms=2 * HOUR,
                                 delay_ms=HOUR))
    want = visits.bounce_detect(nested, within_ms=2 * HOUR).select("seq")
    got = read_topic(spark, f"{tmp_dir}/out")
    assert sorted(got.select("seq").collect()) == sorted(want.collect())
    # a task's group is a visitor's rows of one bucket, a small part of the hot visitor's
    hot = nested.where("common.mid = 'hot'").select("ts")
    sizes = [r["count"] for r in hot.groupBy(F.floor(F.col("ts") / (2 * HOUR))).count().collect()]
    assert max(sizes) * 10 < sum(sizes)


def test_late_and_open_rows(spark, tmp_dir):
    """Same rows as ``test_bounce_stream_out_of_order_and_late_rows`` has for the processor."""
    def row(seq, ts, mid, entry):
        return flat_row(seq, T0 + ts, mid, "0", None if entry else "home")
    parts = [[row(2, 5_000, "a", False), row(1, 0, "a", True)], [row(4, 20_000, "a", True), row(3, 19_500, "b", True)],
             [row(5, 60_000, "z", False)], [row(6, 30_000, "a", True)], [row(7, 10 ** 9, "z", False)]]
    src = topic(spark, f"{tmp_dir}/in", parts)
    drain(spread.start_user_jump(src(), f"{tmp_dir}/out", f"{tmp_dir}/state", f"{tmp_dir}/ck"))
    assert sorted(r.seq for r in read_topic(spark, f"{tmp_dir}/out").collect()) == [3, 4]


def test_a_replayed_batch_changes_nothing(spark, tmp_dir):
    flat = spark.createDataFrame(log_rows(100), P.FLAT_PAGE)
    table = spread.VisitorTable(f"{tmp_dir}/state", "q")
    table.open(spark, None, 0)
    once = sorted(r.seq for r in spread.daily_unique_visit_batch(flat, table, 0)[0].collect())
    values = spread.daily_unique_visit_batch(flat, table, 0)[1]
    assert not table.has(spark, 0)
    assert sorted(r.seq for r in spread.daily_unique_visit_batch(flat, table, 0)[0].collect()) == once
    table.add(values, 0, 0)
    runs = len(dimstore.runs(spark, table.path))
    table.add(values, 0, 0)
    assert table.has(spark, 0) and len(dimstore.runs(spark, table.path)) == runs


def test_expired_dates_are_forgotten(spark, tmp_dir):
    table = spread.VisitorTable(f"{tmp_dir}/state", "q", ttl_ms=1000)
    table.open(spark, spark.createDataFrame([("a", "2024-01-01"), (None, "x")], "mid string, value string"), 5000)
    mids = spark.createDataFrame([("a",), ("b",), ("a",)], "mid string")
    assert [tuple(r) for r in table.of(mids, 5999).collect()] == [("a", "2024-01-01")]
    assert table.of(mids, 6000).collect() == []
