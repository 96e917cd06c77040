"""Batches of file topics: nothing lost under a new checkpoint, nothing twice on a replay."""

from pyspark.sql import functions as F

from retailstream.sources import commits, sinks
from retailstream.sources.tables import read_stats
from retailstream.streaming import jobs


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x string")


def test_two_checkpoints_and_a_replay(spark, tmp_dir):
    where = f"{tmp_dir}/topic"
    sinks.write_topic(rows(spark, "a"), where, batch_id=0, run="q1")
    sinks.write_topic(rows(spark, "b"), where, batch_id=0, run="q2")      # a new checkpoint counts from 0 again
    sinks.write_topic(rows(spark, "a"), where, batch_id=0, run="q1")      # a replay
    got = commits.read_committed(spark, where)
    assert sorted(r.value for r in got.collect()) == ['{"x":"a"}', '{"x":"b"}']
    assert spark.read.parquet(where).count() == 2


def test_a_broken_off_batch_is_not_listed(spark, tmp_dir):
    where = f"{tmp_dir}/topic"
    commits.write_batch(rows(spark, "a"), where, 0, "q")
    rows(spark, "half").write.parquet(f"{where}/{commits.folder_name(1, 'q')}")   # ended before its entry
    assert [r.x for r in commits.read_committed(spark, where).collect()] == ["a"]
    assert commits.write_batch(rows(spark, "b", "c"), where, 1, "q")
    assert not commits.write_batch(rows(spark, "b", "c"), where, 1, "q")
    assert sorted(r.x for r in commits.read_committed(spark, where).collect()) == ["a", "b", "c"]
    assert commits.committed(spark, where) == ["batch=q-0", "batch=q-1"]


def test_statistics_of_two_runs(spark, tmp_dir):
    df = spark.createDataFrame([("2024-01-01 00:00:00", 1)], "stt string, ct long")
    for run in ("q1", "q2", "q1"):
        sinks.write_stats(df, f"{tmp_dir}/stats", ["stt", "ct"], batch_id=0, run=run)
    assert read_stats(spark, f"{tmp_dir}/stats", "2024-01-01").count() == 2
    half = df.withColumn("dt", F.lit("2024-01-01"))
    half.write.partitionBy("dt").parquet(f"{tmp_dir}/stats/{commits.folder_name(1, 'q1')}")
    assert read_stats(spark, f"{tmp_dir}/stats", "2024-01-01").count() == 2   # listed batches only
    sinks.write_routed(spark.createDataFrame([("t", {"id": "1"})], "sink_table string, data map<string,string>"),
                       f"{tmp_dir}/facts", batch_id=0, run="q1")
    assert commits.read_committed(spark, f"{tmp_dir}/facts").select("topic", "value").collect() == [("t", '{"id":"1"}')]


def test_a_job_started_anew_keeps_what_was_there(spark, tmp_dir):
    """The same job with a second checkpoint reads its input again: both runs' batches are there."""
    from retailstream.streaming.processors import FLAT_PAGE
    page = (1, 1000, "m", "v", "c", "a", "1", "p", None, None, None, 0, None, None)
    spark.createDataFrame([page], FLAT_PAGE).write.parquet(f"{tmp_dir}/in")
    ids = []
    for ck in ("ck1", "ck2", "ck2"):
        stream = spark.readStream.schema(FLAT_PAGE).parquet(f"{tmp_dir}/in")
        q = jobs.start_unique_visit(stream, f"{tmp_dir}/uv", f"{tmp_dir}/{ck}", ttl_ms=None)
        q.processAllAvailable()
        ids.append(str(q.id))
        q.stop()
    assert ids[1] == ids[2] != ids[0]   # the id is the checkpoint's
    assert commits.read_committed(spark, f"{tmp_dir}/uv").groupBy("batch").count().where("count > 0").count() == 2
    assert spark.read.parquet(f"{tmp_dir}/uv").count() == 2
