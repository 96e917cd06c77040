"""DWM order jobs: order-time derivation (PRJ-8), interval joins (JN-2/3) and
wide-row merges (PRJ-14/15/16).

Interval joins are equi-joins on the order id with a range condition on event
time.  In batch Spark plans a sort-merge (or AQE broadcast) join with the range
as a post-join filter; on streams the same condition plus watermarks on both
sides lets Spark purge join state (stream-stream inner join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailstream.functions.timefmt import epoch_ms, parse_ts

DAY_MS = 86_400_000


def order_time_fields(order_info: DataFrame, create_time: str = "create_time") -> DataFrame:
    """PRJ-8: create_date ('yyyy-MM-dd'), create_hour ('HH', D4) and create_ts
    (epoch ms, zone-free) from 'yyyy-MM-dd HH:mm:ss'."""
    parts = F.split(F.col(create_time), " ")
    return order_info.withColumns({
        "create_date": parts.getItem(0),
        "create_hour": F.substring(parts.getItem(1), 1, 2),
        "create_ts": epoch_ms(parse_ts(create_time)),
    })


def with_event_ms(df: DataFrame, create_time: str = "create_time", out: str = "ts") -> DataFrame:
    """Event time (epoch ms) of a shop row from its 'yyyy-MM-dd HH:mm:ss' text."""
    return df.withColumn(out, epoch_ms(parse_ts(create_time)))


def interval_join(left: DataFrame, right: DataFrame, on: Column, left_time: Column, right_time: Column,
                  lower, upper) -> DataFrame:
    """Inner interval join: ``on`` and ``left_time + lower <= right_time <=
    left_time + upper`` (both bounds inclusive).  Times are epoch ms with
    integer bounds, or timestamps with interval-string bounds ('5 seconds') —
    the latter form is what a stream-stream join with watermarks needs."""
    if isinstance(lower, str):
        lo = left_time + F.expr(f"INTERVAL {lower}")
        hi = left_time + F.expr(f"INTERVAL {upper}")
    else:
        lo, hi = left_time + F.lit(lower), left_time + F.lit(upper)
    return left.join(right, on & (right_time >= lo) & (right_time <= hi), "inner")


ORDER_SIDE = ("province_id", "order_status", "user_id", "total_amount", "activity_reduce_amount",
              "coupon_reduce_amount", "original_total_amount", "feight_fee", "create_time", "create_date", "create_hour", "create_ts")
DETAIL_SIDE = ("sku_id", "sku_name", "order_price", "sku_num", "split_total_amount", "split_activity_amount",
               "split_coupon_amount")


def order_wide(order_info: DataFrame, order_detail: DataFrame, lower=-5_000, upper=5_000,
               streaming: bool = False) -> DataFrame:
    """JN-2 + PRJ-14: join each detail to its order when the detail time lies in
    [order time + lower, order time + upper]; merge order then detail fields.

    ``order_info`` must carry PRJ-8 fields; both sides need ``create_time``.
    In streaming mode pass interval strings and watermarked ``rt`` columns.
    """
    o = order_info.alias("o")
    d = order_detail.alias("d")
    if "sku_name" not in order_detail.columns:
        d = d.withColumn("sku_name", F.lit(None).cast("string")).alias("d")
    if streaming:
        lt, rt = F.col("o.rt"), F.col("d.rt")
    else:
        d = d.withColumn("_d_ts", epoch_ms(parse_ts("create_time"))).alias("d")
        lt, rt = F.col("o.create_ts"), F.col("d._d_ts")
    j = interval_join(o, d, F.col("o.id") == F.col("d.order_id"), lt, rt, lower, upper)
    return j.select(
        F.col("d.id").alias("detail_id"), F.col("o.id").alias("order_id"),
        *[F.col(f"o.{c}").alias(c) for c in ORDER_SIDE if c in order_info.columns],
        *[F.col(f"d.{c}").alias(c) for c in DETAIL_SIDE if c in d.columns],
        *([F.col("o.rt").alias("rt")] if streaming else []))


# fixed values: the fields that a merge of two order-wide rows may fill in
MERGED = ("order_status", "user_id", "total_amount", "activity_reduce_amount", "coupon_reduce_amount",
          "original_total_amount", "feight_fee", "create_time", "create_date", "sku_id", "sku_name", "order_price",
          "sku_num")


def merge_order_wide(a: DataFrame, b: DataFrame, on: str = "order_id") -> DataFrame:
    """PRJ-15: rows of ``a``, with nulls of the ``MERGED`` fields filled from the row
    of ``b`` with the same key; all other fields keep the value of ``a``."""
    cols = [c for c in a.columns if c != on]
    j = a.alias("a").join(b.alias("b"), on, "left")
    return j.select(on, *[(F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")) if c in MERGED and c in b.columns
                           else F.col(f"a.{c}")).alias(c) for c in cols])


PAYMENT_SIDE = ("payment_type", "subject", "callback_time")


def payment_wide(payment_info: DataFrame, order_wide_df: DataFrame, lower=-15 * 60_000, upper=2_000,
                 streaming: bool = False) -> DataFrame:
    """JN-3 + PRJ-16: join each payment to the order-wide rows of its order whose
    order time lies in [payment time + lower, payment time + upper]; copy the
    order-wide row, then payment fields on top (payment's ``total_amount``,
    ``user_id`` and ``order_id`` win)."""
    p = payment_info.alias("p")
    w = order_wide_df.alias("w")
    if streaming:
        lt, rt = F.col("p.rt"), F.col("w.rt")
    else:
        p = p.withColumn("payment_ts", epoch_ms(parse_ts("create_time"))).alias("p")
        lt, rt = F.col("p.payment_ts"), F.col("w.create_ts")
    j = interval_join(p, w, F.col("p.order_id") == F.col("w.order_id"), lt, rt, lower, upper)
    owned = {"total_amount", "user_id", "order_id", "create_time"}
    wide_cols = [F.col(f"w.{c}").alias(c) for c in order_wide_df.columns if c not in owned and c != "rt"]
    return j.select(
        F.col("p.id").alias("payment_id"), F.col("p.order_id").alias("order_id"),
        F.col("p.user_id").alias("user_id"), F.col("p.total_amount").alias("total_amount"),
        *[F.col(f"p.{c}").alias(c) for c in PAYMENT_SIDE if c in payment_info.columns],
        F.col("p.create_time").alias("payment_create_time"),
        *([F.col("p.payment_ts")] if "payment_ts" in p.columns else []),
        *([F.col("p.rt").alias("rt")] if streaming else []),
        F.col("w.create_time").alias("order_create_time"),
        *wide_cols)
