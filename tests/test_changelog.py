"""Config over time, retractions in batch and on streams, and state that streams take over from batch."""

import os
import random

from pyspark.sql import functions as F

from retailstream.operators import cdc, visits
from retailstream.sources import adapters as A
from retailstream.streaming import processors as P
from tests.conftest import SF_SMALL
from tests.test_streaming import _drain

SCHEMA = "topic string, op string, before map<string,string>, after map<string,string>, seq long"
KEYS = ("sourceTable", "operateType", "sinkType", "sinkTable", "sinkColumns", "sinkPk")


def test_records_meet_the_config_of_their_time(spark):
    """Random config changes and records, 40 % of them of one table, against a walk in order of seq."""
    rng = random.Random(7)
    feed, now, want = [], {}, {}
    tables = ["hot", "a", "b"]
    for seq in range(600):
        table = "hot" if rng.random() < 0.4 else rng.choice(tables)
        if rng.random() < 0.1:
            key = (table, rng.choice(["insert", "update"]))
            image = dict(zip(KEYS, (*key, rng.choice(["kafka", "hbase", "es"]), f"t{seq}", rng.choice(["id", "id,x"]), "id"),
                             strict=True))
            gone = key in now and rng.random() < 0.4
            feed.append(("s.c.table_process", "d" if gone else "c", image if gone else None, None if gone else image, seq))
            now.pop(key, None) if gone else now.update({key: image})
        else:
            op = rng.choice(["c", "u"])
            feed.append((f"s.d.{table}", op, None, {"id": str(seq), "x": "1"}, seq))
            c = now.get((table, cdc.OP_TYPES[op]))
            kinds = {"kafka": "fact", "hbase": "dim"}
            want[seq] = ("no_config", None, "id,x") if c is None else (
                kinds.get(c["sinkType"], "unknown_sink"), c["sinkTable"], c["sinkColumns"])
    changes = cdc.flatten_changes(spark.createDataFrame(feed, SCHEMA))
    routed = cdc.route_changes_as_of(changes.where("tableName != 'table_process'"), cdc.config_intervals(changes))
    got = {r.seq: (r.route, r.sink_table, ",".join(sorted(r.data))) for r in routed.collect()}
    assert got == want and len(got) == routed.count()


def test_a_snapshot_is_valid_until_it_is_changed(spark):
    snap = cdc.table_process(spark, [("a", "insert", "kafka", "old", "id", "id", None)])
    image = dict(zip(KEYS, ("a", "insert", "kafka", "new", "id", "id"), strict=True))
    feed = [("s.d.a", "c", None, {"id": str(i)}, i) for i in (1, 3, 5)] + [
        ("s.c.table_process", "u", image, image, 2), ("s.c.table_process", "d", image, None, 4)]
    changes = cdc.flatten_changes(spark.createDataFrame(feed, SCHEMA))
    out = cdc.route_changes_as_of(changes.where("tableName = 'a'"), cdc.config_intervals(changes, snap)).collect()
    assert {r.seq: r.sink_table for r in out} == {1: "old", 3: "new", 5: None}


def walk(feed):
    """Retractions of ``(key, type, data, seq)`` by a plain walk."""
    now, out = {}, []
    for key, kind, data, seq in sorted(feed, key=lambda r: r[3]):
        old, new = now.get(key), None if kind == "delete" else data
        if old != new:
            out += [(key, seq, "-D" if new is None else "-U", old)] if old is not None else []
            out += [(key, seq, "+I" if old is None else "+U", new)] if new is not None else []
        now[key] = new
    return sorted((*r[:3], tuple(sorted(r[3].items()))) for r in out)


def listed(df):
    return sorted((r.pk, r.seq, r.kind, tuple(sorted(r.data.items()))) for r in df.collect())


def random_feed(n=400):
    rng, feed = random.Random(3), []
    for seq in range(n):
        key = "hot" if rng.random() < 0.4 else str(rng.randrange(20))
        kind = rng.choice(["insert", "update", "update", "delete"])
        feed.append((key, kind, {"id": key, "v": str(rng.randrange(3))}, seq))
    return feed


def as_changes(spark, feed):
    rows = [("d", "t", kind, {} if kind == "delete" else data, data if kind == "delete" else {}, seq)
            for _, kind, data, seq in feed]
    return spark.createDataFrame(
        rows, "database string, tableName string, type string, data map<string,string>, before map<string,string>, seq long")


def test_retractions_against_a_walk(spark):
    feed = random_feed()
    changes = as_changes(spark, feed)
    assert listed(cdc.changelog_retractions(changes)) == walk(feed)
    assert listed(cdc.changelog_retractions(changes, bucket=16)) == walk(feed)   # a key cut into many ranges


def files_in_order(df, path, cuts):
    """One file for each stretch of ``seq``, older ones first."""
    os.makedirs(path)
    for i, (lo, hi) in enumerate(cuts):
        df.where(F.col("seq").between(lo, hi - 1)).coalesce(1).write.parquet(f"{path}-{i}")
        name = next(f for f in os.listdir(f"{path}-{i}") if f.endswith(".parquet"))
        os.link(f"{path}-{i}/{name}", f"{path}/part-{i}.parquet")
        os.utime(f"{path}/part-{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))


def test_retraction_stream_equals_batch_and_gives_the_state(spark, tmp_dir):
    feed = random_feed()
    changes = as_changes(spark, feed)
    files_in_order(changes, f"{tmp_dir}/in", [(0, 120), (120, 300), (300, 400)])
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
    out = _drain(P.changelog_stream(stream), "t_retract", f"{tmp_dir}/ck")
    assert listed(out) == walk(feed)
    # what was given and not taken back is the current state
    held = {}
    for r in sorted(out.collect(), key=lambda r: (r.seq, r.kind[0] == "+")):
        held[r.pk] = r.data if r.kind[0] == "+" else None
    state = {r.data["id"]: r.data for r in cdc.changelog_state(changes).collect()}
    assert {k: v for k, v in held.items() if v is not None} == state


def test_a_late_change_is_dropped(spark, tmp_dir):
    feed = [("1", "insert", {"id": "1", "v": "a"}, 5), ("1", "update", {"id": "1", "v": "b"}, 3)]
    changes = as_changes(spark, feed)
    files_in_order(changes, f"{tmp_dir}/in", [(5, 6), (3, 4)])
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
    out = _drain(P.changelog_stream(stream), "t_late", f"{tmp_dir}/ck").collect()
    assert [(r.seq, r.kind, r.data["v"]) for r in out] == [(5, "+I", "a")]


def test_snapshot_in_batch_then_changes_in_the_stream(spark, tmp_dir):
    """Half the feed as a snapshot, half as a stream: its retractions, over a restart too."""
    feed = random_feed()
    changes = as_changes(spark, feed)
    half = cdc.changelog_state(changes.where("seq < 200")).select(
        "tableName", F.col("data")["id"].alias("pk"), "seq", "data")
    files_in_order(changes, f"{tmp_dir}/in", [(200, 300), (300, 400)])
    got = []
    for i in range(2):   # the second part after a restart
        os.makedirs(f"{tmp_dir}/src", exist_ok=True)
        os.link(f"{tmp_dir}/in/part-{i}.parquet", f"{tmp_dir}/src/part-{i}.parquet")
        stream = spark.readStream.schema(changes.schema).parquet(f"{tmp_dir}/src")
        q = P.changelog_stream(stream, snapshot=half).writeStream.format("parquet").option("path", f"{tmp_dir}/out") \
            .option("checkpointLocation", f"{tmp_dir}/ck").start()
        q.processAllAvailable()
        q.stop()
        got.append(spark.read.parquet(f"{tmp_dir}/out").count())
    assert 0 < got[0] < got[1]
    assert listed(spark.read.parquet(f"{tmp_dir}/out")) == [r for r in walk(feed) if r[1] >= 200]


def test_visits_go_on_from_a_batch_run(spark, tmp_dir):
    """ST-1 and ST-2: half the log in batch, half in the stream that takes its state over."""
    log = A.page_log(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    middle = log.agg(F.expr("percentile_approx(seq, 0.5)")).first()[0]
    first, rest = log.where(F.col("seq") < middle), log.where(F.col("seq") >= middle)
    P.flatten_page_log(rest).coalesce(1).write.parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema(P.FLAT_PAGE).parquet(f"{tmp_dir}/in")
    new = _drain(P.repair_new_visitor_stream(stream, seen=visits.new_visitors_seen(first)), "t_seen", f"{tmp_dir}/ck1")
    want = visits.repair_new_visitor(log).where(F.col("seq") >= middle).select("seq", F.col("common.is_new").alias("is_new"))
    assert sorted(new.select("seq", "is_new").collect()) == sorted(want.collect())
    days = _drain(P.daily_unique_visit_stream(stream, None, last_dates=visits.last_visit_dates(first)), "t_days",
                  f"{tmp_dir}/ck2")
    want = visits.daily_unique_visit(log).where(F.col("seq") >= middle).select("seq")
    assert sorted(days.select("seq").collect()) == sorted(want.collect())
