"""The jobs stated in SQL text, on a stream of JSON records, against the batch statistics."""

from pyspark.sql import functions as F

from retailstream.operators import stats
from retailstream.plans import queries as Q
from retailstream.sources import adapters as A
from retailstream.sources import topics
from retailstream.sources.sinks import to_json_value
from retailstream.sources.tables import Catalog
from retailstream.streaming import sql_jobs
from tests.conftest import SF_SMALL
from tests.test_streaming import _drain


def topic(spark, df, path):
    df.select("seq", F.to_json(F.struct(*[c for c in df.columns if c != "seq"])).alias("value")).coalesce(1).write.parquet(path)
    return topics.read_topic(spark, path, schema=spark.read.parquet(path).schema), topics.read_topic(spark, path, streaming=False)


def test_keywords_by_sql(spark, tmp_dir):
    log = A.search_log(spark.read.parquet(f"{SF_SMALL}/conversations.parquet"))
    stream, table = topic(spark, log, f"{tmp_dir}/topic")
    cols = ["keyword", "ct", "source", "stt", "edt"]
    want = stats.keyword_stats(stats.explode_keywords(stats.search_rows(log)), window="10 minutes")
    batch = sql_jobs.keyword_job(spark, table, "page_table", "10 minutes")
    assert sorted(batch.select(cols).collect()) == sorted(want.select(cols).collect())
    got = _drain(sql_jobs.keyword_job(spark, stream, "page_stream", "10 minutes"), "t_sql_kw", f"{tmp_dir}/ck")
    last = want.agg(F.max("stt")).first()[0]   # still open
    rows = sorted(got.where(F.col("stt") < last).select(cols).collect())
    assert rows and rows == sorted(want.where(F.col("stt") < last).select(cols).collect())


def test_provinces_by_sql(spark, tmp_dir):
    ow = Q.order_wide_df(Catalog(spark, SF_SMALL)).select(
        F.col("detail_id").alias("seq"), "order_id", *stats.PROVINCE_KEYS, "total_amount", "create_time", "create_ts")
    stream, table = topic(spark, ow, f"{tmp_dir}/topic")
    cols = ["stt", "edt", "province_id", "province_name", "order_amount"]
    want = stats.province_stats(ow, window="1 day", as_of_s=F.lit(0))
    batch = sql_jobs.province_job(spark, table, "order_table", "1 day")
    exact = [*cols, "order_count"]
    assert sorted(batch.select(exact).collect()) == sorted(want.select(exact).collect())
    got = _drain(sql_jobs.province_job(spark, stream, "order_stream", "1 day"), "t_sql_prov", f"{tmp_dir}/ck")
    last = want.agg(F.max("stt")).first()[0]
    rows = sorted(got.where(F.col("stt") < last).select(exact).collect())
    assert rows and rows == sorted(want.where(F.col("stt") < last).select(exact).collect())   # small counts: exact too


def test_json_table_is_a_view(spark):
    rows = to_json_value(spark.createDataFrame([("2024-01-01 00:00:01", 2)], "create_time string, x long"))
    out = topics.json_table(rows, rows.sparkSession.createDataFrame([], "create_time string, x long").schema,
                            F.to_timestamp("create_time"), view="json_rows")
    assert out.columns == ["create_time", "x", "rt"]
    assert spark.sql("SELECT date_format(rt, 'HH:mm:ss') AS t, x FROM json_rows").collect() == [("00:00:01", 2)]
