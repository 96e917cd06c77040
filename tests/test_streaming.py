"""Batch-versus-stream parity on the smallest supplied tables, fed in several
micro-batches.  A far-future non-entry sentinel row advances the watermark so
every real window / pending row is closed."""

import os
import time

import pytest
from pyspark.sql import functions as F

from retailstream.operators import cdc, orders, stats, visits
from retailstream.plans import queries as Q
from retailstream.sources import adapters as A
from retailstream.sources import sinks
from retailstream.sources.tables import Catalog
from retailstream.streaming import jobs
from retailstream.streaming import processors as P
from tests.conftest import SF_SMALL

SENTINEL = (10 ** 9, 4_102_444_800_000, "sentinel", "0", "0", "0", "0", "home", "home", None, None, 0, None, None)


@pytest.fixture(scope="module")
def page_files(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("pages"))
    log = A.page_log(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    flat = P.flatten_page_log(log)
    for lo, hi in ((0, 300), (300, 700), (700, 10 ** 8)):
        flat.where((F.col("seq") >= lo) & (F.col("seq") < hi)).coalesce(1).write.mode("append").parquet(f"{d}/in")
    spark.createDataFrame([SENTINEL], P.FLAT_PAGE).coalesce(1).write.mode("append").parquet(f"{d}/in")
    return d, log


def _stream(spark, d):
    return spark.readStream.schema(P.FLAT_PAGE).option("maxFilesPerTrigger", 1).parquet(f"{d}/in")


def _drain(df, name, ckpt, mode="append", expect_input=None):
    """Run until all input is processed.  Queries in processing-time mode keep
    running no-data batches forever, so for them wait until ``expect_input``
    rows have been reported as processed."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode) \
        .option("checkpointLocation", ckpt).start()
    if expect_input is None:
        q.processAllAvailable()
    else:
        deadline = time.time() + 120
        while time.time() < deadline:
            seen = sum(p["numInputRows"] for p in q.recentProgress)
            if seen >= expect_input and not q.status["isTriggerActive"]:
                break
            time.sleep(0.5)
    q.stop()
    return df.sparkSession.table(name)


def test_processors_match_batch(spark, page_files):
    d, log = page_files
    real = F.col("mid") != "sentinel"
    r1 = _drain(P.repair_new_visitor_stream(_stream(spark, d)), "t_st1", f"{d}/ck1").where(real)
    b1 = visits.repair_new_visitor(log).select("seq", F.col("common.is_new").alias("is_new"))
    assert sorted(r1.select("seq", "is_new").collect()) == sorted(b1.collect())
    n_in = log.count() + 1
    r2 = _drain(P.daily_unique_visit_stream(_stream(spark, d)), "t_st2", f"{d}/ck2", expect_input=n_in).where(real)
    assert sorted(r2.select("seq").collect()) == sorted(visits.daily_unique_visit(log).select("seq").collect())
    within = 6 * 3_600_000
    r3 = _drain(P.bounce_detect_stream(_stream(spark, d), within, "1 second"), "t_st3", f"{d}/ck3").where(real)
    b3 = visits.bounce_detect(log, within_ms=within).select("seq")
    assert sorted(r3.select("seq").collect()) == sorted(b3.collect())


def test_visitor_stats_stream_closed_windows_match_batch(spark, page_files):
    d, log = page_files
    within = 6 * 3_600_000
    uv_b = visits.daily_unique_visit(log)
    uj_b = visits.bounce_detect(log, within_ms=within)
    # the three DWM topics as files; the stream reads all three
    sentinel = spark.createDataFrame([SENTINEL], P.FLAT_PAGE)
    for name, df in (("uv", P.flatten_page_log(uv_b)), ("uj", P.flatten_page_log(uj_b))):
        df.unionByName(sentinel).coalesce(1).write.mode("overwrite").parquet(f"{d}/{name}")  # every input advances
    pages = _stream(spark, d)
    uv = spark.readStream.schema(P.FLAT_PAGE).parquet(f"{d}/uv")
    uj = spark.readStream.schema(P.FLAT_PAGE).parquet(f"{d}/uj")
    s = _drain(jobs.visitor_stats_stream(pages, uv, uj, window="1 hour", delay="0 seconds"), "t_vs", f"{d}/ck4")
    b = stats.visitor_stats(stats.visitor_measure_rows(log, uv_b, uj_b), window="1 hour")
    cols = ["stt", "vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts"]
    got = sorted(tuple(r) for r in s.where(F.col("stt") < "2100").select(cols).collect())
    assert got == sorted(tuple(r) for r in b.select(cols).collect())


def test_order_wide_stream_join_matches_batch(spark, tmp_dir):
    oi = A.order_info(spark.read.parquet(f"{SF_SMALL}/orders.parquet"),
                      spark.read.parquet(f"{SF_SMALL}/customer.parquet"))
    od = A.order_detail(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"))
    oi.write.parquet(f"{tmp_dir}/oi")
    od.write.parquet(f"{tmp_dir}/od")
    so = spark.readStream.schema(oi.schema).parquet(f"{tmp_dir}/oi")
    sd = spark.readStream.schema(od.schema).parquet(f"{tmp_dir}/od")
    s = _drain(jobs.order_wide_stream(so, sd, "-5 days", "5 days", "0 seconds"), "t_ow", f"{tmp_dir}/ck")
    b = orders.order_wide(orders.order_time_fields(oi), od, -5 * 86_400_000, 5 * 86_400_000)
    cols = ["order_id", "detail_id", "sku_id", "create_ts", "split_total_amount"]
    assert sorted(s.select(cols).collect()) == sorted(b.select(cols).collect())


def test_keyword_stats_stream_matches_batch(spark, tmp_dir):
    conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    A.search_log(conv).write.parquet(f"{tmp_dir}/search")
    schema = spark.read.parquet(f"{tmp_dir}/search").schema
    src = spark.readStream.schema(schema).parquet(f"{tmp_dir}/search")
    s = _drain(jobs.keyword_stats_stream(src, window="10 minutes", delay="1 second"), "t_kw", f"{tmp_dir}/ck")
    b = stats.keyword_stats(stats.explode_keywords(stats.search_rows(A.search_log(conv))), window="10 minutes")
    # the last hour stays open in append mode; every closed window must match
    last = b.agg(F.max("stt")).first()[0]
    got = sorted(tuple(r) for r in s.where(F.col("stt") < last).select("keyword", "ct", "stt").collect())
    assert got and got == sorted(tuple(r) for r in b.where(F.col("stt") < last).select("keyword", "ct", "stt").collect())


def test_change_router_end_to_end(spark, tmp_dir):
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    A.order_changes(o).unionByName(A.user_changes(c)).write.parquet(f"{tmp_dir}/env")
    env = spark.read.parquet(f"{tmp_dir}/env")
    stream = spark.readStream.schema(env.schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp_dir}/env")
    q = jobs.start_change_router(stream, lambda: cdc.table_process(spark, Q.ROUTING), f"{tmp_dir}/facts",
                                 f"{tmp_dir}/dims", f"{tmp_dir}/rejects", f"{tmp_dir}/ck")
    q.processAllAvailable()
    q.stop()
    dim = sinks.read_dimension(spark, f"{tmp_dir}/dims/dim_user_info")
    batch = Q.q_dim_upsert(spark, SF_SMALL)
    assert sorted(dim.select("id", "name", "nation", "acctbal").collect()) == \
        sorted(batch.select("id", "name", "nation", "acctbal").collect())
    facts = spark.read.parquet(f"{tmp_dir}/facts")
    n_insert = cdc.flatten_changes(env).where((F.col("tableName") == "order_info") & (F.col("type") == "insert"))
    assert facts.where(F.col("topic") == "dwd_order_info").count() == n_insert.count()
    assert spark.read.parquet(f"{tmp_dir}/rejects").where(F.col("route") == "unknown_sink").count() > 0


def test_restart_from_checkpoint_gives_same_result(spark, page_files, tmp_dir):
    """Stop after the first input file, restart from the checkpoint with the
    rest: the union of both runs equals one uninterrupted run (state restored)."""
    d, log = page_files
    src = f"{tmp_dir}/in"
    # arrival order must follow seq: order the slices by their smallest seq (names are random)
    files = sorted((f for f in os.listdir(f"{d}/in") if f.endswith(".parquet")),
                   key=lambda f: spark.read.parquet(f"{d}/in/{f}").agg(F.min("seq")).first()[0])
    os.makedirs(src)
    os.link(f"{d}/in/{files[0]}", f"{src}/{files[0]}")
    ck = f"{tmp_dir}/ck"

    out = f"{tmp_dir}/out"

    def run():
        s = spark.readStream.schema(P.FLAT_PAGE).parquet(src)
        q = P.repair_new_visitor_stream(s).writeStream.format("parquet").option("path", out) \
            .option("checkpointLocation", ck).start()
        q.processAllAvailable()
        q.stop()

    run()
    n_first = spark.read.parquet(out).count()
    for f in files[1:]:
        os.link(f"{d}/in/{f}", f"{src}/{f}")
    run()
    rows = spark.read.parquet(out).collect()
    assert 0 < n_first < len(rows)
    got = sorted((r["seq"], r["is_new"]) for r in rows if r["mid"] != "sentinel")
    want = sorted(tuple(r) for r in visits.repair_new_visitor(log).select("seq", "common.is_new").collect())
    assert got == want


def test_snapshot_then_changes_and_sql_view(spark):
    snap = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, name string")
    ch = cdc.flatten_changes(spark.createDataFrame(
        [("s.d.t", "u", None, {"id": "1", "name": "z"}, 5), ("s.d.t", "d", {"id": "2"}, None, 6),
         ("s.d.t", "c", None, {"id": "3", "name": "c"}, 7)],
        "topic string, op string, before map<string,string>, after map<string,string>, seq long"))
    st = cdc.snapshot_then_changes(snap, ch, table="t")
    assert sorted((r["data"]["id"], r["data"]["name"]) for r in st.collect()) == [("1", "z"), ("3", "c")]
    cdc.register_current_state(ch, "t_current", ["id", "name"], table="t")
    assert sorted(tuple(r) for r in spark.sql("SELECT id, name FROM t_current").collect()) == [("1", "z"), ("3", "c")]


def test_log_split_job_writes_every_topic(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    raw = A.raw_log(ev)
    raw.write.parquet(f"{tmp_dir}/raw")
    src = spark.readStream.schema(raw.schema).parquet(f"{tmp_dir}/raw")
    for q in jobs.start_log_split(src, f"{tmp_dir}/topics", f"{tmp_dir}/ck"):   # the split and the dirty output
        q.processAllAvailable()
        q.stop()
    n = {e: ev.where(F.col("event_type") == e).count() for e in ("signup", "error", "view")}
    assert spark.read.parquet(f"{tmp_dir}/topics/dirty").count() == n["error"]
    assert spark.read.parquet(f"{tmp_dir}/topics/start").count() == n["signup"]
    assert spark.read.parquet(f"{tmp_dir}/topics/page").count() == ev.count() - n["error"] - n["signup"]
    assert spark.read.parquet(f"{tmp_dir}/topics/display").count() == 2 * n["view"]
    page = spark.read.json(spark.read.parquet(f"{tmp_dir}/topics/page").rdd.map(lambda r: r.value))
    assert set(page.columns) >= {"mid", "is_new", "page_id", "ts", "seq"}


def test_product_and_province_streams_match_batch(spark, tmp_dir):
    ow = Q.order_wide_df(Catalog(spark, SF_SMALL))
    ow.write.parquet(f"{tmp_dir}/ow")
    s_ow = spark.readStream.schema(ow.schema).parquet(f"{tmp_dir}/ow")
    parts = [stats.order_rows(s_ow)]
    s = _drain(jobs.product_stats_stream(parts, window="1 day", delay="0 seconds"), "t_ps", f"{tmp_dir}/ck1")
    b = stats.product_stats(stats.union_product_rows([stats.order_rows(ow)]), window="1 day")
    last = b.agg(F.max("stt")).first()[0]
    cols = ["stt", "sku_id", "order_sku_num", "order_amount", "order_ct", "ts"]
    assert sorted(s.where(F.col("stt") < last).select(cols).collect()) == \
        sorted(b.where(F.col("stt") < last).select(cols).collect())

    v = spark.readStream.schema(ow.schema).parquet(f"{tmp_dir}/ow")
    ps = _drain(jobs.province_stats_stream(v, window="1 day", delay="0 seconds"), "t_prov", f"{tmp_dir}/ck2")
    pb = stats.province_stats(ow, window="1 day", as_of_s=F.lit(0))
    cols = ["stt", "province_id", "province_name", "order_amount", "order_count"]
    assert sorted(ps.where(F.col("stt") < last).select(cols).collect()) == \
        sorted(pb.where(F.col("stt") < last).select(cols).collect())


def test_payment_wide_stream_matches_batch(spark, tmp_dir):
    c_li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    c_o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    ow = Q.order_wide_df(Catalog(spark, SF_SMALL))
    pay = A.payment_info(c_li, c_o)
    ow.write.parquet(f"{tmp_dir}/ow")
    pay.write.parquet(f"{tmp_dir}/pay")
    sp = spark.readStream.schema(pay.schema).parquet(f"{tmp_dir}/pay")
    sw = spark.readStream.schema(ow.schema).parquet(f"{tmp_dir}/ow")
    s = _drain(jobs.payment_wide_stream(sp, sw, "-15 days", "2 days"), "t_pw", f"{tmp_dir}/ck")
    b = orders.payment_wide(pay, ow, *Q.PAYMENT_ORDER_BOUNDS)
    cols = ["payment_id", "order_id", "total_amount", "payment_ts", "sku_id", "order_create_time"]
    assert sorted(s.select(cols).collect()) == sorted(b.select(cols).collect())


def test_topic_chained_jobs_and_stats_table(spark, page_files, tmp_dir):
    """pages -> user-jump job -> JSON topic -> parsed back -> visitor-stats job ->
    stats table partitioned by dt -> one-day read with partition pruning."""
    from retailstream.operators import reports
    from retailstream.sources import tables, topics
    d, log = page_files
    within = 6 * 3_600_000
    q = jobs.start_user_jump(_stream(spark, d), f"{tmp_dir}/uj", f"{tmp_dir}/ck_uj", within_ms=within)
    q.processAllAvailable()
    q.stop()
    uj_topic = topics.read_topic(spark, f"{tmp_dir}/uj", streaming=False)
    uj_rows = uj_topic.select(F.from_json("value", P.FLAT_PAGE).alias("r")).select("r.*")
    assert sorted(r[0] for r in uj_rows.select("seq").collect()) == \
        sorted(r[0] for r in visits.bounce_detect(log, within_ms=within).select("seq").collect())

    # the DWS job reads the DWM topic as a stream of JSON text
    uj_stream = spark.readStream.schema(uj_topic.schema).parquet(f"{tmp_dir}/uj") \
        .select(F.from_json("value", P.FLAT_PAGE).alias("r")).select("r.*")
    uv_b = visits.daily_unique_visit(log)
    P.flatten_page_log(uv_b).unionByName(spark.createDataFrame([SENTINEL], P.FLAT_PAGE)) \
        .write.parquet(f"{tmp_dir}/uv")
    uv_stream = spark.readStream.schema(P.FLAT_PAGE).parquet(f"{tmp_dir}/uv")
    q = jobs.start_visitor_stats(_stream(spark, d), uv_stream, uj_stream, f"{tmp_dir}/stats",
                                 f"{tmp_dir}/ck_vs", window="1 hour", delay="0 seconds")
    q.processAllAvailable()
    q.stop()
    day = "2024-01-02"
    got = tables.read_stats(spark, f"{tmp_dir}/stats", day)
    b = stats.visitor_stats(stats.visitor_measure_rows(log, uv_b, visits.bounce_detect(log, within_ms=within)),
                            window="1 hour")
    want = reports.with_dt(b).where(F.col("dt") == day)
    cols = ["stt", "vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())
    buf = __import__("io").StringIO()
    with __import__("contextlib").redirect_stdout(buf):
        got.explain("formatted")
    assert "PartitionFilters" in buf.getvalue() and day in buf.getvalue()


def test_order_wide_and_product_jobs_with_dimension_reload(spark, tmp_dir):
    c = lambda t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
    oi = A.order_info(c("orders"), c("customer"))
    od = A.order_detail(c("lineitem"))
    oi.write.parquet(f"{tmp_dir}/oi")
    od.write.parquet(f"{tmp_dir}/od")
    loads = []

    def load_dims():
        loads.append(1)   # re-read every micro-batch (D6)
        return {"user": A.dim_user_info(c("customer")), "province": A.dim_base_province(c("nation"), c("region")),
                "sku": A.dim_sku_info(c("part")), "spu": A.dim_spu_info(c("part")),
                "trademark": A.dim_base_trademark(c("part")), "category3": A.dim_base_category3(c("part"))}

    so = spark.readStream.schema(oi.schema).parquet(f"{tmp_dir}/oi")
    sd = spark.readStream.schema(od.schema).parquet(f"{tmp_dir}/od")
    q = jobs.start_order_wide(so, sd, load_dims, f"{tmp_dir}/ow", f"{tmp_dir}/ck_ow",
                              as_of=F.lit(Q.AS_OF).cast("timestamp_ntz"), lower="-5 days", upper="5 days")
    q.processAllAvailable()
    q.stop()
    ow_rows = spark.read.parquet(f"{tmp_dir}/ow").select(F.from_json("value", Q.order_wide_df(Catalog(spark, SF_SMALL)).schema)
                                                         .alias("r")).select("r.*")
    batch = Q.order_wide_df(Catalog(spark, SF_SMALL))
    cols = ["order_id", "detail_id", "sku_name", "spu_name", "tm_name", "province_name", "user_age"]
    assert loads and sorted(ow_rows.select(cols).collect()) == sorted(batch.select(cols).collect())

    topic_schema = spark.read.parquet(f"{tmp_dir}/ow").schema
    ow_stream = spark.readStream.schema(topic_schema).parquet(f"{tmp_dir}/ow") \
        .select(F.from_json("value", batch.schema).alias("r")).select("r.*")
    q = jobs.start_product_stats([stats.order_rows(ow_stream)], load_dims, f"{tmp_dir}/ps", f"{tmp_dir}/ck_ps",
                                 window="1 day", delay="0 seconds")
    q.processAllAvailable()
    q.stop()
    ps = spark.read.parquet(f"{tmp_dir}/ps")
    assert ps.count() > 0 and ps.where(F.col("sku_name").isNull()).count() == 0
    assert set(jobs.PRODUCT_COLUMNS) <= set(ps.columns)


def test_bounce_stream_out_of_order_and_late_rows(spark, tmp_dir):
    """Out-of-order rows inside the 1 s tolerance are re-ordered by event time;
    a row older than the watermark when it arrives is dropped (late)."""
    T = 1_704_067_200_000

    def row(seq, ts, mid, entry):
        return (seq, T + ts, mid, "v", "c", "a", "0", "p", None if entry else "home", None, None, 0, None, None)

    batches = [
        [row(2, 5_000, "a", False), row(1, 0, "a", True)],          # reversed inside a batch
        [row(4, 20_000, "a", True), row(3, 19_500, "b", True)],     # 'b' arrives 0.5 s behind 'a'
        [row(5, 60_000, "z", False)],                               # moves the watermark to 59 s
        [row(6, 30_000, "a", True)],                                 # late: older than the watermark
        [row(7, 10 ** 9, "z", False)],                               # flush
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, P.FLAT_PAGE).coalesce(1).write.parquet(f"{tmp_dir}/in/b{i}")
    import glob
    import shutil
    os.makedirs(f"{tmp_dir}/src")
    for i in range(len(batches)):   # one file per trigger, in this order
        f = glob.glob(f"{tmp_dir}/in/b{i}/*.parquet")[0]
        shutil.copy(f, f"{tmp_dir}/src/part-{i:03d}.parquet")
        os.utime(f"{tmp_dir}/src/part-{i:03d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    s = spark.readStream.schema(P.FLAT_PAGE).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/src")
    out = _drain(P.bounce_detect_stream(s, 10_000, "1 second"), "t_ooo", f"{tmp_dir}/ck")
    # a: entry at 0 s stays (non-entry 5 s later); entry at 20 s times out; the late entry is gone
    # b: entry at 19.5 s, no successor -> bounce
    assert sorted(r[0] for r in out.select("seq").collect()) == [3, 4]
