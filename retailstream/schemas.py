"""Record schemas.  Streams are never schema-inferred."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DecimalType, LongType, MapType, StringType, StructField,
                               StructType)

S, L = StringType(), LongType()
MONEY = DecimalType(18, 2)


def _struct(*names: str, types: dict | None = None) -> StructType:
    types = types or {}
    return StructType([StructField(n, types.get(n, S)) for n in names])


COMMON = _struct("mid", "is_new", "vc", "ch", "ar", "uid", "md", "os", "ba", "page_id")
PAGE = _struct("page_id", "last_page_id", "item", "item_type", "during_time", "source_type",
               types={"during_time": L})
DISPLAY = _struct("item", "item_type", "display_type", "order", "pos_id")

# raw click log line; ``start`` kept as a map (its content is not used downstream)
RAW_LOG = StructType([
    StructField("common", COMMON), StructField("start", MapType(S, S)), StructField("page", PAGE),
    StructField("displays", ArrayType(DISPLAY)), StructField("ts", L),
])

PAGE_LOG = StructType([
    StructField("common", COMMON), StructField("page", PAGE), StructField("displays", ArrayType(DISPLAY)),
    StructField("ts", L), StructField("seq", L),
])

CHANGE_EVENT = StructType([
    StructField("topic", S), StructField("op", S), StructField("before", MapType(S, S)),
    StructField("after", MapType(S, S)), StructField("seq", L),
])

CHANGE_FLAT = StructType([
    StructField("database", S), StructField("tableName", S), StructField("type", S),
    StructField("data", MapType(S, S)), StructField("before", MapType(S, S)), StructField("seq", L),
])

TABLE_PROCESS = _struct("sourceTable", "operateType", "sinkType", "sinkTable", "sinkColumns", "sinkPk",
                        "sinkExtend")

ORDER_INFO = _struct("id", "province_id", "user_id", "order_status", "total_amount", "activity_reduce_amount",
                     "coupon_reduce_amount", "original_total_amount", "feight_fee", "create_time",
                     types={"id": L, "province_id": L, "user_id": L, "total_amount": MONEY,
                            "activity_reduce_amount": MONEY, "coupon_reduce_amount": MONEY,
                            "original_total_amount": MONEY, "feight_fee": MONEY})
ORDER_DETAIL = _struct("id", "order_id", "sku_id", "sku_num", "order_price", "split_total_amount",
                       "split_activity_amount", "split_coupon_amount", "create_time",
                       types={"id": L, "order_id": L, "sku_id": L, "sku_num": L, "order_price": MONEY,
                              "split_total_amount": MONEY, "split_activity_amount": MONEY,
                              "split_coupon_amount": MONEY})
PAYMENT_INFO = _struct("id", "order_id", "user_id", "total_amount", "subject", "payment_type", "create_time",
                       "callback_time",
                       types={"id": L, "order_id": L, "user_id": L, "total_amount": MONEY})

VISITOR_STATS = _struct("stt", "edt", "vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum",
                        "ts", types={k: L for k in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts")})
