from decimal import Decimal

from pyspark.sql import functions as F

from retailstream.operators import dims, orders

MS = 1


def _orders(spark):
    oi = spark.createDataFrame(
        [(1, 10, 100, "1001", Decimal("50.00"), "2024-01-01 10:00:00"),
         (2, 11, 101, "1001", Decimal("70.00"), "2024-01-01 10:00:00")],
        "id long, province_id long, user_id long, order_status string, total_amount decimal(18,2), create_time string")
    return orders.order_time_fields(oi)


def test_order_time_fields(spark):
    r = _orders(spark).select("create_date", "create_hour", "create_ts").first()
    assert tuple(r) == ("2024-01-01", "10", 1704103200000)


def test_order_detail_interval_bounds_inclusive(spark):
    od = spark.createDataFrame(
        [(1, 1, 5, 1, "2024-01-01 09:59:55"),   # -5 s: in
         (2, 1, 5, 1, "2024-01-01 10:00:05"),   # +5 s: in
         (3, 1, 5, 1, "2024-01-01 10:00:06"),   # +6 s: out
         (4, 1, 5, 1, "2024-01-01 09:59:54"),   # -6 s: out
         (5, 3, 5, 1, "2024-01-01 10:00:00")],  # no order
        "id long, order_id long, sku_id long, sku_num long, create_time string") \
        .withColumn("order_price", F.lit(1).cast("decimal(18,2)")) \
        .withColumn("split_total_amount", F.lit(1).cast("decimal(18,2)"))
    ow = orders.order_wide(_orders(spark), od, -5_000, 5_000)
    assert sorted(r[0] for r in ow.select("detail_id").collect()) == [1, 2]


def test_one_ms_outside_is_out(spark):
    od = spark.createDataFrame([(1, 1, 5, 1, "2024-01-01 10:00:05")], "id long, order_id long, sku_id long, "
                               "sku_num long, create_time string") \
        .withColumn("order_price", F.lit(1).cast("decimal(18,2)")) \
        .withColumn("split_total_amount", F.lit(1).cast("decimal(18,2)"))
    assert orders.order_wide(_orders(spark), od, -5_000, 4_999).count() == 0
    assert orders.order_wide(_orders(spark), od, -5_000, 5_000).count() == 1


def test_payment_bounds_and_payment_fields_win(spark):
    od = spark.createDataFrame([(1, 1, 5, 1, "2024-01-01 10:00:00")], "id long, order_id long, sku_id long, "
                               "sku_num long, create_time string") \
        .withColumn("order_price", F.lit(1).cast("decimal(18,2)")) \
        .withColumn("split_total_amount", F.lit(1).cast("decimal(18,2)"))
    ow = orders.order_wide(_orders(spark), od, -5_000, 5_000)
    pay = spark.createDataFrame(
        [(9, 1, 999, Decimal("1.23"), "2024-01-01 10:15:00"),   # order at pay - 15 min: in
         (8, 1, 999, Decimal("1.23"), "2024-01-01 09:59:58"),   # order at pay + 2 s: in
         (7, 1, 999, Decimal("1.23"), "2024-01-01 10:15:01"),   # out
         (6, 1, 999, Decimal("1.23"), "2024-01-01 09:59:57")],  # out
        "id long, order_id long, user_id long, total_amount decimal(18,2), create_time string")
    pw = orders.payment_wide(pay, ow)
    rows = pw.select("payment_id", "user_id", "total_amount", "order_create_time").collect()
    assert sorted(r[0] for r in rows) == [8, 9]
    assert all(r["user_id"] == 999 and r["total_amount"] == Decimal("1.23") for r in rows)


def test_enrich_missing_dimension_keeps_row(spark):
    facts = spark.createDataFrame([(1, 5), (2, 6)], "id long, sku_id long")
    sku = spark.createDataFrame([("5", "phone", "9.99", "s1", "t1", "c1")],
                                "id string, sku_name string, price string, spu_id string, tm_id string, "
                                "category3_id string")
    r = dims.enrich_sku(facts, sku, with_price=True).orderBy("id").collect()
    assert r[0]["sku_name"] == "phone" and r[0]["sku_price"] == Decimal("9.99")
    assert r[1]["sku_name"] is None and r[1]["id"] == 2


def test_grown_dimension_is_seen_and_building_the_plan_runs_nothing(spark, tmp_dir):
    facts = spark.createDataFrame([(1, 5), (2, 6)], "id long, sku_id long")
    schema = "id string, sku_name string, price string, spu_id string, tm_id string, category3_id string"
    spark.createDataFrame([("5", "phone", "9", "s", "t", "c")], schema).write.parquet(f"{tmp_dir}/sku")
    look = lambda: dims.enrich_sku(facts, spark.read.parquet(f"{tmp_dir}/sku")).select("id", "sku_name")
    assert sorted(tuple(r) for r in look().collect()) == [(1, "phone"), (2, None)]
    spark.createDataFrame([("6", "watch", "9", "s", "t", "c")], schema).write.mode("append").parquet(f"{tmp_dir}/sku")
    assert sorted(tuple(r) for r in look().collect()) == [(1, "phone"), (2, "watch")]


def test_merge_order_wide_first_non_null(spark):
    a = spark.createDataFrame([(1, None, Decimal("1.00")), (2, "x", None)],
                              "order_id long, sku_name string, split_total_amount decimal(18,2)")
    b = spark.createDataFrame([(1, "y", Decimal("9.00")), (2, "z", Decimal("9.00"))],
                              "order_id long, sku_name string, split_total_amount decimal(18,2)")
    r = {x["order_id"]: (x["sku_name"], x["split_total_amount"])
         for x in orders.merge_order_wide(a, b).collect()}
    assert r == {1: ("y", Decimal("1.00")), 2: ("x", None)}
