from decimal import Decimal


from retailstream.operators import reports, stats
from tests.conftest import page_rows

T0 = 1_704_067_200_000


def test_window_edge_at_ten_seconds(spark):
    log = page_rows(spark, [(1, T0 + 9_999, "a", "1", None, "home", None, None, 4),
                            (2, T0 + 10_000, "a", "1", "home", "home", None, None, 6)])
    empty = log.limit(0)
    vs = stats.visitor_stats(stats.visitor_measure_rows(log, empty, empty), window="10 seconds")
    r = sorted((x["stt"], x["pv_ct"], x["sv_ct"], x["dur_sum"], x["ts"]) for x in vs.collect())
    assert r == [("2024-01-01 00:00:00", 1, 1, 4, T0 + 9_999), ("2024-01-01 00:00:10", 1, 0, 6, T0 + 10_000)]


def test_product_union_defaults_and_distinct_orders(spark):
    orders_ = spark.createDataFrame(
        [(5, 2, Decimal("10.00"), 100, T0), (5, 1, Decimal("10.00"), 100, T0 + 1),   # same order twice
         (5, 1, Decimal("3.00"), None, T0 + 2)],                                    # null order id (D12)
        "sku_id long, order_sku_num long, order_amount decimal(38,2), order_oid long, ts long")
    clicks = spark.createDataFrame([(5, 1, T0)], "sku_id long, click_ct long, ts long")
    u = stats.union_product_rows([orders_, clicks])
    r = stats.product_stats(u, "10 seconds").first()
    assert (r["click_ct"], r["order_sku_num"], r["order_amount"], r["order_ct"], r["favor_ct"],
            r["payment_amount"]) == (1, 4, Decimal("23.00"), 1, 0, Decimal("0.00"))


def test_keyword_tie_top_n_by_keyword(spark):
    ks = spark.createDataFrame(
        [("b", 2, "SEARCH", "2024-01-01 00:00:00"), ("a", 2, "CLICK", "2024-01-01 00:00:00"),
         ("c", 1, "SEARCH", "2024-01-01 00:00:00")], "keyword string, ct long, source string, stt string")
    r = reports.keyword_score_top_n(ks, n=2, date="2024-01-01").collect()
    # ordered by unweighted count (tie 2/2 broken by keyword), score weighted
    assert [(x["keyword"], x["ct"]) for x in r] == [("a", 2), ("b", 20)]


def test_hour_report_zero_fill_and_flag_table(spark):
    vs = spark.createDataFrame(
        [("2024-01-01 03:00:00", "1", 2, 5, 2, 1, 3000), ("2024-01-01 03:00:10", "0", 0, 0, 0, 0, 0),
         ("2024-01-01 05:00:00", "0", 1, 2, 0, 0, 10)],
        "stt string, is_new string, uv_ct long, pv_ct long, sv_ct long, uj_ct long, dur_sum long")
    h = reports.visitors_by_hour(vs, date="2024-01-01").collect()
    assert len(h) == 24 and h[3]["hr"] == "03" and h[3]["new_uv"] == 2 and h[4]["uv_ct"] == 0
    t = {r["metric"]: (r["new"], r["old"]) for r in reports.visitor_flag_table(vs, date="2024-01-01").collect()}
    assert t["uj_rate"] == (Decimal("50.00"), Decimal("0.00"))          # old: sv = 0 with uv > 0 -> 0
    assert t["dur_per_sv"] == (Decimal("1.50"), Decimal("0.00"))
    assert t["pv_per_sv"] == (Decimal("2.50"), Decimal("0.00"))


def test_trademark_top_n_having_positive(spark):
    ps = spark.createDataFrame(
        [("2024-01-01 00:00:00", "t1", "T1", Decimal("5.00")), ("2024-01-01 00:00:10", "t1", "T1", Decimal("1.00")),
         ("2024-01-01 00:00:00", "t2", "T2", Decimal("0.00")), ("2024-01-02 00:00:00", "t3", "T3", Decimal("9.00"))],
        "stt string, tm_id string, tm_name string, order_amount decimal(38,2)")
    one = reports.trademark_top_n(ps, 10, "2024-01-01").collect()
    assert [(r["tm_id"], r["order_amount"]) for r in one] == [("t1", Decimal("6.00"))]
    every = reports.trademark_top_n(ps, 10).collect()
    assert sorted((r["dt"], r["tm_id"]) for r in every) == [("2024-01-01", "t1"), ("2024-01-02", "t3")]
    assert reports.gmv(ps, "2024-01-03").first()["gmv"] is None


def test_null_time_or_key_rows_are_rejected_not_grouped(spark):
    rows = spark.createDataFrame([(5, 1, T0), (None, 1, T0), (5, 1, None)], "sku_id long, click_ct long, ts long")
    good, bad = stats.split_rejects(rows, ["sku_id"])
    assert good.count() == 1 and bad.count() == 2
    r = stats.product_stats(stats.union_product_rows([rows]), "10 seconds").collect()
    assert [(x["sku_id"], x["click_ct"]) for x in r] == [(5, 1)]
