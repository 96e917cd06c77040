import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from retailstream.functions import metrics, timefmt
from retailstream.functions.keywords import keyword_weight, tokenize


def test_epoch_ms_is_zone_free(spark):
    rows = [(dt.datetime(2024, 7, 1, 12, 34, 56, 789123),), (dt.datetime(2024, 3, 10, 2, 30),),
            (dt.datetime(1969, 12, 31, 23, 59, 59, 500000),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        got = {}
        for tz in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got[tz] = [r[0] for r in df.select(timefmt.epoch_ms("ts")).collect()]
        assert got["UTC"] == got["America/Los_Angeles"] == [1719837296789, 1710037800000, -500]
        back = df.select(timefmt.from_epoch_ms(timefmt.epoch_ms("ts"))).collect()
        assert back[1][0] == dt.datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_parse_ts_and_seconds_trunc(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:10", 1704067210999), ("bad", 0)], "s string, ms long")
    r = df.select(timefmt.epoch_ms(timefmt.parse_ts("s")).alias("a"),
                  timefmt.epoch_ms(timefmt.seconds_trunc("ms")).alias("b")).collect()
    assert r[0]["a"] == 1704067210000 and r[0]["b"] == 1704067210000
    assert r[1]["a"] is None


def test_age_truncates(spark):
    # 2000-06-07 -> 2024-06-01 is 8760 days = exactly 24 * 365; one day later is 8759
    df = spark.createDataFrame([("2000-06-07",), ("2000-06-08",)], "b string")
    r = df.select(timefmt.age_years("b", F.lit("2024-06-01 00:00:00").cast("timestamp_ntz"))).collect()
    assert [x[0] for x in r] == [24, 23]


def test_ratios_half_up_exact(spark):
    df = spark.createDataFrame([(1, 5, 2, 1, 3), (0, 5, 2, 1, 3), (3, 4, 0, 2, 0), (2, 1, 8, 1, 8000)],
                               "uv_ct long, pv_ct long, sv_ct long, uj_ct long, dur_sum long")
    r = df.select(*metrics.visitor_ratios()).collect()
    # 1*100/2 = 50.00 ; dur 3/2 = 1.5 -> 2 ms -> 0.0 s ; pv 5/2 = 2.50
    assert r[0] == (Decimal("50.00"), Decimal("0.00"), Decimal("2.50"))
    assert r[1] == (Decimal("0.00"),) * 3          # uv = 0
    assert r[2] == (Decimal("0.00"),) * 3          # sv = 0 with uv > 0 (D7): no error
    assert r[3] == (Decimal("12.50"), Decimal("1.00"), Decimal("0.13"))  # 1/8 -> 0.125 -> 0.13


def test_tokenize_and_weights(spark):
    df = spark.createDataFrame([("Hello, Wörld 42x 小米手机 ok",), ("",), (None,)], "t string")
    r = df.select(tokenize("t")).collect()
    assert r[0][0] == ["hello", "wörld", "42x", "小米手机", "ok"]
    assert r[1][0] == [] and r[2][0] == []
    w = spark.createDataFrame([("SEARCH",), ("ORDER",), ("CART",), ("CLICK",), ("X",)], "s string")
    assert [x[0] for x in w.select(keyword_weight("s")).collect()] == [10, 3, 2, 1, 0]


def test_split_keyword_udtf_matches_tokenizer(spark):
    from retailstream.functions.keywords import register_split_keyword
    register_split_keyword(spark)
    conv = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    conv.createOrReplaceTempView("conv_t")
    via_sql = spark.sql("SELECT conv_id, turn, word FROM conv_t, LATERAL split_keyword(text)")
    via_jvm = conv.select("conv_id", "turn", F.explode(tokenize("text")).alias("word"))
    assert sorted(via_sql.collect()) == sorted(via_jvm.collect())


def test_zoned_text_and_epoch_ms(spark):
    df = spark.createDataFrame([(1704067200000, "2024-01-01 08:00:00")], "ms long, s string")
    r = df.select(timefmt.ms_to_string("ms", "Asia/Shanghai").alias("a"),
                  timefmt.string_to_ms("s", "Asia/Shanghai").alias("b"),
                  timefmt.ms_to_string("ms", "UTC").alias("c")).first()
    assert (r["a"], r["b"], r["c"]) == ("2024-01-01 08:00:00", 1704067200000, "2024-01-01 00:00:00")


def test_window_bounds_are_the_same_text_in_batch_and_on_streams(spark):
    """Whatever the session's zone: UTC by default, or the zone asked for."""
    keep = spark.conf.get("spark.sql.session.timeZone")
    ms = 1704067205000   # 2024-01-01 00:00:05 UTC
    try:
        for session in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", session)
            df = spark.createDataFrame([(ms,)], "ms long")
            for zone, want in (("UTC", "2024-01-01 00:00:00"), ("Asia/Shanghai", "2024-01-01 08:00:00")):
                batch = df.select(F.window(timefmt.from_epoch_ms("ms"), "10 seconds").alias("window"))
                stream = df.select(F.window(F.timestamp_millis("ms"), "10 seconds").alias("window"))
                assert batch.select(*timefmt.window_bounds(zone=zone)).first()["stt"] == want
                assert stream.select(*timefmt.window_bounds(streaming=True, zone=zone)).first()["stt"] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", keep)
