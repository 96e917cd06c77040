"""Adapters: project the supplied test tables onto the reference's record shapes.

The test data has no click log, change feed or shop tables, so each adapter is a
fixed, documented rule over a supplied table (FIXTURES.md).  All are plain
projections/joins, so they push down and prune like any other query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from retailstream.functions.timefmt import epoch_ms, ts_string

MONEY = DecimalType(18, 2)


def _s(c: Column) -> Column:
    return c.cast("string")


# ---------------------------------------------------------------------------
# click log
# ---------------------------------------------------------------------------

def _event_cols(events: DataFrame) -> DataFrame:
    e = F.col("event_type")
    k = F.get_json_object("props", "$.k")
    return events.select(
        F.col("event_id").alias("seq"),
        epoch_ms("ts").alias("ts"),
        _s(F.col("user_id")).alias("mid"),
        _s(F.col("user_id") % 3).alias("vc"),
        _s(F.col("user_id") % 4).alias("ch"),
        _s(F.col("user_id") % 7).alias("ar"),
        F.when(e.isin("signup", "view"), "1").otherwise("0").alias("is_new"),
        F.when(e == "click", "good_detail").otherwise(e).alias("page_id"),
        F.when(e.isin("signup", "view", "error"), F.lit(None).cast("string")).otherwise("home")
         .alias("last_page_id"),
        F.when(e == "click", k).alias("item"),
        F.when(e == "click", "sku_id").alias("item_type"),
        F.round(F.col("value") * 1000).cast("long").alias("during_time"),
        k.alias("k"),
        e.alias("event_type"),
    )


def _displays(e: Column, k: Column, mid: Column) -> Column:
    """view -> two displays (one SKU, one activity); click -> []; others -> null."""
    disp = "struct<item:string,item_type:string>"
    return (F.when(e == "view", F.array(
                F.struct(k.alias("item"), F.lit("sku_id").alias("item_type")),
                F.struct(mid.alias("item"), F.lit("activity").alias("item_type"))))
            .when(e == "click", F.array().cast(f"array<{disp}>"))
            .otherwise(F.lit(None).cast(f"array<{disp}>")))


def page_log(events: DataFrame) -> DataFrame:
    """events -> page log rows ``common, page, displays, ts (ms), seq`` (FIXTURES)."""
    x = _event_cols(events)
    return x.select(
        F.struct("mid", "is_new", "vc", "ch", "ar").alias("common"),
        F.struct("page_id", "last_page_id", "item", "item_type", "during_time").alias("page"),
        _displays(F.col("event_type"), F.col("k"), F.col("mid")).alias("displays"),
        "ts", "seq")


def raw_log(events: DataFrame) -> DataFrame:
    """events -> raw JSON log lines ``seq, value`` as a collector writes them.

    signup -> a start record; error -> a malformed line: a page record cut short,
    or (even seq) one with text after it; everything else -> a page record with
    displays, purchases with ``during_time`` as text and ``ts`` as a decimal.
    """
    x = _event_cols(events)
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    qn = lambda c: F.coalesce(q(c), F.lit("null"))
    common = F.concat(F.lit('{"common":{"mid":'), q(F.col("mid")), F.lit(',"is_new":'), q(F.col("is_new")),
                      F.lit(',"vc":'), q(F.col("vc")), F.lit(',"ch":'), q(F.col("ch")),
                      F.lit(',"ar":'), q(F.col("ar")), F.lit("}"))
    e = F.col("event_type")
    displays = (F.when(e == "view", F.concat(F.lit('[{"item":'), q(F.col("k")),
                                             F.lit(',"item_type":"sku_id"},{"item":'), q(F.col("mid")),
                                             F.lit(',"item_type":"activity"}]')))
                .when(e == "click", F.lit("[]")).otherwise(F.lit("null")))
    page = F.concat(common, F.lit(',"page":{"page_id":'), q(F.col("page_id")),
                    F.lit(',"last_page_id":'), qn(F.col("last_page_id")),
                    F.lit(',"item":'), qn(F.col("item")), F.lit(',"item_type":'), qn(F.col("item_type")),
                    F.lit(',"during_time":'),
                    F.when(e == "purchase", q(_s(F.col("during_time")))).otherwise(_s(F.col("during_time"))),
                    F.lit('},"displays":'), displays, F.lit(',"ts":'), _s(F.col("ts")),
                    F.when(e == "purchase", F.lit(".0")).otherwise(F.lit("")), F.lit("}"))
    start = F.concat(common, F.lit(',"start":{"entry":"icon","loading_time":'), _s(F.col("during_time")),
                     F.lit(',"open_ad_id":'), q(F.col("k")), F.lit('},"ts":'), _s(F.col("ts")), F.lit("}"))
    value = (F.when(e == "signup", start)
             .when((e == "error") & (F.col("seq") % 2 == 0), F.concat(F.col("_page"), F.lit(" garbage")))
             .when(e == "error", F.expr("substring(_page, 1, length(_page) - 1)"))
             .otherwise(F.col("_page")))
    return x.withColumn("_page", page).select("seq", value.alias("value"))


def search_log(conversations: DataFrame, base_ms: int = 1_704_067_200_000) -> DataFrame:
    """conversations -> page-log rows of a chat page.  A user turn is a search
    (``item_type='keyword'``, ``item`` = the whole text); other turns are
    replies.  Event time = base + conv_id minutes + turn seconds."""
    ts = F.lit(base_ms) + F.col("conv_id") * 60_000 + F.col("turn") * 1000
    kw = F.col("role") == "user"
    return conversations.select(
        F.struct(_s(F.col("conv_id")).alias("mid"), F.lit("0").alias("is_new"), F.lit("0").alias("vc"),
                 F.lit("0").alias("ch"), F.lit("0").alias("ar")).alias("common"),
        F.struct(F.lit("good_list").alias("page_id"), F.lit("home").alias("last_page_id"),
                 F.col("text").alias("item"), F.when(kw, "keyword").otherwise("reply").alias("item_type"),
                 F.lit(0).cast("long").alias("during_time")).alias("page"),
        ts.cast("long").alias("ts"), (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"))


def favor_info(events: DataFrame) -> DataFrame:
    """view events mark the viewed SKU as favourite: ``sku_id, ts``."""
    return events.where(F.col("event_type") == "view").select(
        F.get_json_object("props", "$.k").cast("long").alias("sku_id"), epoch_ms("ts").alias("ts"))


def cart_info(events: DataFrame) -> DataFrame:
    """purchase events put the SKU into the cart: ``sku_id, ts``."""
    return events.where(F.col("event_type") == "purchase").select(
        F.get_json_object("props", "$.k").cast("long").alias("sku_id"), epoch_ms("ts").alias("ts"))


# ---------------------------------------------------------------------------
# shop tables
# ---------------------------------------------------------------------------

def order_info(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """orders (+ customer's nation as province) -> order_info."""
    cust = customer.select(F.col("c_custkey"), F.col("c_nationkey").cast("long").alias("province_id"))
    o = orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
    amount = F.col("o_totalprice").cast(MONEY)
    return o.select(
        F.col("o_orderkey").alias("id"), "province_id", F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        amount.alias("total_amount"),
        (amount * F.lit("0.01").cast(DecimalType(4, 2))).cast(MONEY).alias("activity_reduce_amount"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(5)).otherwise(0).cast(MONEY).alias("coupon_reduce_amount"),
        amount.alias("original_total_amount"),
        F.lit(0).cast(MONEY).alias("feight_fee"),
        ts_string("o_orderdate").alias("create_time"))


def order_detail(lineitem: DataFrame) -> DataFrame:
    """lineitem -> order_detail (``id`` = line number; lineitem has no unique key)."""
    price = F.col("l_extendedprice").cast(MONEY)
    return lineitem.select(
        F.col("l_linenumber").cast("long").alias("id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"), F.col("l_quantity").cast("long").alias("sku_num"),
        price.alias("order_price"),
        (price * (F.lit(1) - F.col("l_discount").cast(DecimalType(4, 2)))).cast(MONEY)
         .alias("split_total_amount"),
        (price * F.col("l_discount").cast(DecimalType(4, 2))).cast(MONEY).alias("split_activity_amount"),
        (price * F.col("l_tax").cast(DecimalType(4, 2))).cast(MONEY).alias("split_coupon_amount"),
        ts_string("l_shipdate").alias("create_time"))


def payment_info(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Shipped-and-finished lines (``l_linestatus='F'``) are paid at ship time."""
    li = lineitem.where(F.col("l_linestatus") == "F")
    o = orders.select("o_orderkey", "o_custkey")
    p = li.join(o, li.l_orderkey == o.o_orderkey, "left")
    return p.select(
        F.col("l_linenumber").cast("long").alias("id"), F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_extendedprice").cast(MONEY).alias("total_amount"),
        F.concat(F.lit("line "), _s(F.col("l_linenumber"))).alias("subject"),
        F.concat(F.lit("11"), F.lpad(_s(F.col("l_suppkey") % 3 + 1), 2, "0")).alias("payment_type"),
        ts_string("l_shipdate").alias("create_time"),
        ts_string(F.col("l_shipdate") + F.expr("INTERVAL 1 HOUR")).alias("callback_time"))


def order_refund_info(lineitem: DataFrame) -> DataFrame:
    """Returned lines (``l_returnflag='R'``) are refunds at ship time."""
    return lineitem.where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").cast(MONEY).alias("refund_amount"),
        ts_string("l_shipdate").alias("create_time"))


def comment_info(lineitem: DataFrame) -> DataFrame:
    """Finished lines get a comment; a discount under 5% is a good one ('1201')."""
    return lineitem.where(F.col("l_linestatus") == "F").select(
        F.col("l_partkey").alias("sku_id"),
        F.when(F.col("l_discount") < 0.05, "1201").otherwise("1202").alias("appraise"),
        ts_string("l_shipdate").alias("create_time"))


# ---------------------------------------------------------------------------
# dimensions (all-string, as the reference's dimension store)
# ---------------------------------------------------------------------------

def dim_user_info(customer: DataFrame) -> DataFrame:
    return customer.select(
        _s(F.col("c_custkey")).alias("id"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") * 37 % 20000)
                                 .cast("int")), "yyyy-MM-dd").alias("birthday"))


def dim_base_province(nation: DataFrame, region: DataFrame) -> DataFrame:
    r = region.select("r_regionkey", "r_name")
    n = nation.join(r, nation.n_regionkey == r.r_regionkey, "left")
    nk = F.lpad(_s(F.col("n_nationkey")), 2, "0")
    return n.select(_s(F.col("n_nationkey")).alias("id"), F.col("n_name").alias("name"),
                    F.col("r_name").alias("area_code"), F.concat(F.lit("N"), nk).alias("iso_code"),
                    F.concat(F.substring("r_name", 1, 2), F.lit("-"), nk).alias("iso_3166_2"))


def dim_sku_info(part: DataFrame) -> DataFrame:
    """part -> SKU dimension: p_name = SPU, p_brand = trademark, p_type = category-3."""
    return part.select(_s(F.col("p_partkey")).alias("id"), F.col("p_name").alias("sku_name"),
                       _s(F.col("p_retailprice").cast(MONEY)).alias("price"),
                       F.col("p_name").alias("spu_id"), F.col("p_brand").alias("tm_id"),
                       F.col("p_type").alias("category3_id"))


def dim_spu_info(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_name").alias("id"), F.col("p_name").alias("spu_name")).distinct()


def dim_base_trademark(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_brand").alias("id"), F.col("p_brand").alias("tm_name")).distinct()


def dim_base_category3(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_type").alias("id"), F.col("p_type").alias("name")).distinct()


# ---------------------------------------------------------------------------
# change feed (Debezium-style envelopes)
# ---------------------------------------------------------------------------

_ENVELOPE = ("struct<op:string,seq:bigint,before:map<string,string>,after:map<string,string>>")


def order_changes(orders: DataFrame, server: str = "erp", db: str = "shop") -> DataFrame:
    """orders -> change envelopes ``topic, op, before, after, seq``.

    Each order is created (``r`` = snapshot before 1996, else ``c``); finished or
    pending orders get an update of ``order_status``; pending urgent orders are
    then deleted.  seq = 4 * key + step, so it orders the changes of one key.
    """
    key = F.col("o_orderkey")
    created = F.create_map(
        F.lit("id"), _s(key), F.lit("user_id"), _s(F.col("o_custkey")),
        F.lit("order_status"), F.lit("1001"),
        F.lit("total_amount"), _s(F.col("o_totalprice").cast(MONEY)),
        F.lit("create_time"), ts_string("o_orderdate"))
    status = F.when(F.col("o_orderstatus") == "F", "1004").otherwise("1002")
    updated = F.map_concat(F.map_filter(created, lambda k, v: k != "order_status"),
                           F.create_map(F.lit("order_status"), status))
    none = F.lit(None).cast("map<string,string>")
    steps = F.array(
        F.struct(F.when(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"), "r")
                 .otherwise("c").alias("op"), (key * 4).alias("seq"), none.alias("before"), created.alias("after")),
        F.when(F.col("o_orderstatus").isin("F", "P"),
               F.struct(F.lit("u").alias("op"), (key * 4 + 1).alias("seq"), created.alias("before"),
                        updated.alias("after"))),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"),
               F.struct(F.lit("d").alias("op"), (key * 4 + 2).alias("seq"), updated.alias("before"),
                        none.alias("after"))),
    )
    x = orders.select(F.explode(F.filter(steps, lambda s: s.isNotNull())).alias("c"))
    return x.select(F.lit(f"{server}.{db}.order_info").alias("topic"), "c.op", "c.before", "c.after", "c.seq")


def user_changes(customer: DataFrame, server: str = "erp", db: str = "shop") -> DataFrame:
    """customer -> change envelopes: a snapshot row each, and a balance update
    for the BUILDING segment."""
    key = F.col("c_custkey")
    base = F.create_map(F.lit("id"), _s(key), F.lit("name"), F.col("c_name"),
                        F.lit("nation"), _s(F.col("c_nationkey")),
                        F.lit("acctbal"), _s(F.col("c_acctbal").cast(MONEY)),
                        F.lit("segment"), F.col("c_mktsegment"))
    upd = F.map_concat(F.map_filter(base, lambda k, v: k != "acctbal"),
                       F.create_map(F.lit("acctbal"), _s((F.col("c_acctbal") + 100).cast(MONEY))))
    none = F.lit(None).cast("map<string,string>")
    steps = F.array(
        F.struct(F.lit("r").alias("op"), (key * 4).alias("seq"), none.alias("before"), base.alias("after")),
        F.when(F.col("c_mktsegment") == "BUILDING",
               F.struct(F.lit("u").alias("op"), (key * 4 + 1).alias("seq"), base.alias("before"),
                        upd.alias("after"))),
    )
    x = customer.select(F.explode(F.filter(steps, lambda s: s.isNotNull())).alias("c"))
    return x.select(F.lit(f"{server}.{db}.user_info").alias("topic"), "c.op", "c.before", "c.after", "c.seq")
