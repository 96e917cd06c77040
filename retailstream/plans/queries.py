"""Registered end-to-end queries over the supplied tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame built only from
the operators of this package applied to the whole tables.  Test-scale
parameters (the data spans weeks, not seconds) are module constants:
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailstream.operators import reports, stats, visits
from retailstream.sources import adapters as A
from retailstream.sources.tables import Catalog

# Test-scale parameters: the click log spans 30 days with minutes between a
# visitor's events, so the 10 s bounce limit and window become 6 h and 1 h.
BOUNCE_WITHIN_MS = 6 * 3_600_000
VISITOR_WINDOW = "1 hour"


# ---------------------------------------------------------------------------
# click-log / visitor slice
# ---------------------------------------------------------------------------

def _page_log(spark: SparkSession, sf: str) -> DataFrame:
    return A.page_log(Catalog(spark, sf).events)


def page_log_df(c: Catalog) -> DataFrame:
    return c.once("page_log", lambda: A.page_log(c.events))


def q_new_visitor_repair(spark, sf):
    log = _page_log(spark, sf)
    fixed = visits.repair_new_visitor(log.withColumn("is_new_raw", F.col("common.is_new")))
    return fixed.select("seq", F.col("common.mid").alias("mid"), "is_new_raw",
                        F.col("common.is_new").alias("is_new"))


def q_daily_unique_visit(spark, sf):
    uv = visits.daily_unique_visit(_page_log(spark, sf))
    return uv.select("seq", F.col("common.mid").alias("mid"), "ts")


def q_bounce_detect(spark, sf):
    uj = visits.bounce_detect(_page_log(spark, sf), within_ms=BOUNCE_WITHIN_MS)
    return uj.select("seq", F.col("common.mid").alias("mid"), "ts")


def q_bounce_outcomes(spark, sf):
    """ST-3: matches and timeouts of the pattern, and when they are certain."""
    uj = visits.bounce_outcomes(_page_log(spark, sf), within_ms=BOUNCE_WITHIN_MS)
    return uj.select("seq", F.col("common.mid").alias("mid"), "ts", "outcome", "decided_at")


def visitor_stats_df(c: Catalog) -> DataFrame:
    log = page_log_df(c)
    rows = stats.visitor_measure_rows(log, visits.daily_unique_visit(log),
                                      visits.bounce_detect(log, within_ms=BOUNCE_WITHIN_MS))
    return stats.visitor_stats(rows, window=VISITOR_WINDOW)


def q_visitor_stats(spark, sf):
    return visitor_stats_df(Catalog(spark, sf))


def q_visitor_by_hour(spark, sf):
    return reports.visitors_by_hour(visitor_stats_df(Catalog(spark, sf)))


def q_visitor_by_flag(spark, sf):
    return reports.visitors_by_flag(visitor_stats_df(Catalog(spark, sf)))


def q_visitor_flag_table(spark, sf):
    return reports.visitor_flag_table(visitor_stats_df(Catalog(spark, sf)))


QUERIES = {
    "new_visitor_repair": q_new_visitor_repair,
    "daily_unique_visit": q_daily_unique_visit,
    "bounce_detect": q_bounce_detect,
    "bounce_outcomes": q_bounce_outcomes,
    "visitor_stats": q_visitor_stats,
    "visitor_by_hour": q_visitor_by_hour,
    "visitor_by_flag": q_visitor_by_flag,
    "visitor_flag_table": q_visitor_flag_table,
}


# ---------------------------------------------------------------------------
# raw click log: parse, repair, split
# ---------------------------------------------------------------------------

def _parsed_log(spark, sf):
    from retailstream.operators import logs
    raw = A.raw_log(Catalog(spark, sf).events)
    return logs.split_dirty(logs.parse_json(raw))


def q_dirty_split(spark, sf):
    _, dirty = _parsed_log(spark, sf)
    return dirty.select("seq", "value")


def _routed(spark, sf):
    from retailstream.operators import logs
    import uuid

    from retailstream.sources.tables import materialize
    clean, _ = _parsed_log(spark, sf)
    # lines are parsed once, into a table that the repair's branches read; the route
    # is decided there too, and the text goes no further
    rows = materialize(logs.route_start_page(logs.flatten(clean)).drop("start_text"), f"dwd_log-{uuid.uuid4().hex}")
    return visits.repair_new_visitor(rows)


def q_start_page_split(spark, sf):
    r = _routed(spark, sf)
    return r.select("seq", "route", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"),
                    F.col("page.page_id").alias("page_id"), F.col("page.last_page_id").alias("last_page_id"),
                    F.col("start")["entry"].alias("start_entry"), "ts")


def q_display_explode(spark, sf):
    from retailstream.operators import logs
    r = _routed(spark, sf)
    d = logs.explode_displays(r.where(F.col("route") == "page"))
    return d.select("seq", F.col("common.mid").alias("mid"), "page_id", "item", "item_type", "ts")


QUERIES.update({
    "dirty_split": q_dirty_split,
    "start_page_split": q_start_page_split,
    "display_explode": q_display_explode,
})


# ---------------------------------------------------------------------------
# orders, payments, dimensions
# ---------------------------------------------------------------------------

from retailstream.operators import dims, orders  # noqa: E402

DAY_MS = 86_400_000
# Test-scale: order dates are midnights, so seconds become days.
ORDER_DETAIL_BOUNDS = (-5 * DAY_MS, 5 * DAY_MS)      # reference: -5 s, +5 s
PAYMENT_ORDER_BOUNDS = (-15 * DAY_MS, 2 * DAY_MS)    # reference: -15 min, +2 s
PRODUCT_WINDOW = "1 day"                             # reference: 10 s
PROVINCE_WINDOW = "1 day"
KEYWORD_WINDOW = "1 hour"
AS_OF = "2024-06-01 00:00:00"        # fixed "now" for ages and processing-time ts
AS_OF_S = 1_717_200_000              # the same instant in epoch seconds


def _as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def order_core_df(c: Catalog) -> DataFrame:
    """Order joined to its details, before any lookup: all that order and payment
    measures need."""
    def build() -> DataFrame:
        oi = orders.order_time_fields(A.order_info(c.orders, c.customer))
        return orders.order_wide(oi, A.order_detail(c.lineitem), *ORDER_DETAIL_BOUNDS)
    return c.once("order_core", build)


def enrich_order_wide(core: DataFrame, c: Catalog) -> DataFrame:
    ow = dims.enrich_user(core, A.dim_user_info(c.customer), _as_of())
    ow = dims.enrich_province(ow, A.dim_base_province(c.nation, c.region))
    return enrich_product(ow, c)


def enrich_product(df: DataFrame, c: Catalog, with_price: bool = False) -> DataFrame:
    return dims.enrich_product(df, A.dim_sku_info(c.part), A.dim_spu_info(c.part), A.dim_base_trademark(c.part),
                               A.dim_base_category3(c.part), with_price=with_price)


def order_wide_df(c: Catalog) -> DataFrame:
    return enrich_order_wide(order_core_df(c), c)


def pay_orders(order_rows: DataFrame, c: Catalog) -> DataFrame:
    """Payments joined to ``order_rows`` (core or enriched)."""
    return orders.payment_wide(A.payment_info(c.lineitem, c.orders), order_rows, *PAYMENT_ORDER_BOUNDS)


def payment_wide_df(c: Catalog) -> DataFrame:
    return pay_orders(order_wide_df(c), c)


def q_order_wide(spark, sf):
    return order_wide_df(Catalog(spark, sf))


def q_payment_wide(spark, sf):
    return payment_wide_df(Catalog(spark, sf))


def q_dim_user_age(spark, sf):
    c = Catalog(spark, sf)
    o = c.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))
    return dims.enrich_user(o, A.dim_user_info(c.customer), _as_of())


# ---------------------------------------------------------------------------
# product / province / keyword statistics and their reports
# ---------------------------------------------------------------------------

def product_measure_rows(pages: DataFrame, order_rows: DataFrame, payments: DataFrame, c: Catalog) -> DataFrame:
    """SET-2: the seven measure-row inputs of the product statistics."""
    return stats.union_product_rows([
        stats.click_display_rows(pages), stats.favor_rows(A.favor_info(c.events)),
        stats.cart_rows(A.cart_info(c.events)), stats.order_rows(order_rows), stats.payment_rows(payments),
        stats.refund_rows(orders.with_event_ms(A.order_refund_info(c.lineitem))),
        stats.comment_rows(orders.with_event_ms(A.comment_info(c.lineitem)))])


def product_counts_df(c: Catalog) -> DataFrame:
    """AG-2 before the lookups: one row per window and SKU."""
    core = order_core_df(c)
    return stats.product_stats(product_measure_rows(page_log_df(c), core, pay_orders(core, c), c),
                               window=PRODUCT_WINDOW)


def product_stats_df(c: Catalog) -> DataFrame:
    return enrich_product(product_counts_df(c), c, with_price=True)


def province_counts_df(c: Catalog) -> DataFrame:
    """AG-3 before the lookup: it needs the province of an order and nothing of its products."""
    return stats.province_stats(order_core_df(c), window=PROVINCE_WINDOW, as_of_s=F.lit(AS_OF_S), keys=["province_id"])


def province_stats_df(c: Catalog) -> DataFrame:
    out = dims.enrich_province(province_counts_df(c), A.dim_base_province(c.nation, c.region))
    return out.select("stt", "edt", *stats.PROVINCE_KEYS, "order_amount", "order_count", "ts")


def keyword_stats_df(c: Catalog) -> DataFrame:
    words = stats.explode_keywords(stats.search_rows(A.search_log(c.conversations)))
    return stats.keyword_stats(words, window=KEYWORD_WINDOW, as_of_s=F.lit(AS_OF_S))


def product_keyword_stats_df(c: Catalog) -> DataFrame:
    """Keywords of product names: ordered (ORDER), carted (CART), clicked (CLICK)."""
    skus = A.dim_sku_info(c.part)
    ev = c.events
    clicks = stats.click_display_rows(page_log_df(c)).where(F.col("click_ct") == 1).select("sku_id", "ts")
    srcs = {
        "ORDER": dims.enrich_sku(order_core_df(c), skus).select(F.col("sku_name").alias("full_word"),
                                                                F.col("create_ts").alias("ts")),
        "CART": dims.enrich_sku(A.cart_info(ev), skus).select(F.col("sku_name").alias("full_word"), "ts"),
        "CLICK": dims.enrich_sku(clicks, skus).select(F.col("sku_name").alias("full_word"), "ts"),
    }
    out = None
    for src, rows in srcs.items():
        k = stats.keyword_stats(stats.explode_keywords(rows), window=KEYWORD_WINDOW, source=src,
                                as_of_s=F.lit(AS_OF_S))
        out = k if out is None else out.unionByName(k)
    return out


def q_product_stats(spark, sf):
    return product_stats_df(Catalog(spark, sf))


def q_gmv(spark, sf):
    return reports.gmv(product_counts_df(Catalog(spark, sf)))


def _amount_topn(spark, sf, key, names, name, out_name, **kw):
    c = Catalog(spark, sf)
    return reports.amount_top_n_of(product_counts_df(c), A.dim_sku_info(c.part), key, names(c.part), name, out_name, **kw)


def q_brand_topn(spark, sf):
    return _amount_topn(spark, sf, "tm_id", A.dim_base_trademark, "tm_name", "tm_name")


def q_category_topn(spark, sf):
    return _amount_topn(spark, sf, "category3_id", A.dim_base_category3, "name", "category3_name")


def q_spu_topn(spark, sf):
    return _amount_topn(spark, sf, "spu_id", A.dim_spu_info, "spu_name", "spu_name", with_order_ct=True)


def q_province_stats(spark, sf):
    return province_stats_df(Catalog(spark, sf))


def q_province_totals(spark, sf):
    c = Catalog(spark, sf)
    return reports.province_amounts_of(province_counts_df(c), A.dim_base_province(c.nation, c.region))


def q_keyword_stats(spark, sf):
    return keyword_stats_df(Catalog(spark, sf))


def q_keyword_score(spark, sf):
    c = Catalog(spark, sf)
    return reports.keyword_score_top_n(keyword_stats_df(c).unionByName(product_keyword_stats_df(c)))


QUERIES.update({
    "order_wide": q_order_wide,
    "payment_wide": q_payment_wide,
    "dim_user_age": q_dim_user_age,
    "product_stats": q_product_stats,
    "gmv": q_gmv,
    "brand_topn": q_brand_topn,
    "category_topn": q_category_topn,
    "spu_topn": q_spu_topn,
    "province_stats": q_province_stats,
    "province_totals": q_province_totals,
    "keyword_stats": q_keyword_stats,
    "keyword_score": q_keyword_score,
})


# ---------------------------------------------------------------------------
# change data capture
# ---------------------------------------------------------------------------

from retailstream.operators import cdc  # noqa: E402

# Routing config at test scale (one row per table and change type).  The second
# order_info/insert row has a larger seq and replaces the first.
ROUTING = [
    ("order_info", "insert", "kafka", "dwd_order_info", "id,user_id,total_amount,order_status,create_time", "id",
     None, 1),
    ("order_info", "insert", "kafka", "dwd_order_info", "id,user_id,total_amount,order_status", "id", None, 2),
    ("order_info", "update", "clickhouse", "order_status_stats", "id,order_status", "id", None, 1),
    ("user_info", "insert", "hbase", "dim_user_info", "id,name,nation,acctbal", "id", None, 1),
    ("user_info", "update", "hbase", "dim_user_info", "id,name,nation,acctbal", "id", None, 1),
]
USER_DIM_COLUMNS = ("id", "name", "nation", "acctbal")


def _changes(spark, sf) -> DataFrame:
    c = Catalog(spark, sf)
    return cdc.flatten_changes(A.order_changes(c.orders).unionByName(A.user_changes(c.customer)))


def _routed_changes(spark, sf) -> DataFrame:
    return cdc.route_changes(cdc.drop_deletes(_changes(spark, sf)), cdc.table_process(spark, ROUTING))


def q_cdc_flatten(spark, sf):
    ch = _changes(spark, sf)
    return ch.select("seq", "database", F.col("tableName").alias("table_name"), "type",
                     F.col("data")["id"].alias("data_id"), F.col("data")["order_status"].alias("data_status"),
                     F.col("before")["order_status"].alias("before_status"),
                     F.size("data").alias("n_data"), F.size("before").alias("n_before"))


def q_cdc_route(spark, sf):
    r = _routed_changes(spark, sf)
    return r.select("seq", F.col("tableName").alias("table_name"), "type", "route", "sink_type", "sink_table",
                    F.array_join(F.array_sort(F.map_keys("data")), ",").alias("cols"),
                    F.col("data")["id"].alias("data_id"))


def _dim_changes(spark, sf, config) -> DataFrame:
    """Routed changes of dimension tables; the others' records are not even built, as the filter is on
    the sources' constant table names."""
    ch = cdc.drop_deletes(_changes(spark, sf)).where(F.col("tableName").isin(cdc.dimension_sources(config)))
    return cdc.split_routes(cdc.route_changes(ch, config))["dim"]


def q_dim_upsert(spark, sf):
    dim = _dim_changes(spark, sf, cdc.table_process(spark, ROUTING))
    return cdc.upsert_dimension(None, cdc.dim_rows(dim, USER_DIM_COLUMNS, "dim_user_info"))


def q_changelog_state(spark, sf):
    orders_only = _changes(spark, sf).where(F.col("tableName") == "order_info")
    st = cdc.changelog_state(orders_only)
    return st.select(F.col("data")["id"].cast("long").alias("id"), F.col("data")["order_status"].alias("order_status"),
                     F.col("data")["total_amount"].alias("total_amount"),
                     F.col("data")["user_id"].alias("user_id"), "seq")


QUERIES.update({
    "cdc_flatten": q_cdc_flatten,
    "cdc_route": q_cdc_route,
    "dim_upsert": q_dim_upsert,
    "changelog_state": q_changelog_state,
})


# An update that carries fewer columns than the insert, under its own config.
PARTIAL_ROUTING = [
    ("user_info", "insert", "hbase", "dim_user_info", "id,name,nation", "id", None, 1),
    ("user_info", "update", "hbase", "dim_user_info", "id,acctbal", "id", None, 1),
]


def q_dim_upsert_partial(spark, sf):
    """Current table of names and segments; changes of names, nations and balances."""
    c = Catalog(spark, sf)
    current = c.customer.select(F.col("c_custkey").cast("string").alias("id"), F.lit("old").alias("name"),
                                F.col("c_mktsegment").alias("segment"), F.lit(-1).cast("long").alias("seq"))
    routed = cdc.route_changes(cdc.flatten_changes(A.user_changes(c.customer)),
                               cdc.table_process(spark, PARTIAL_ROUTING))
    rows = cdc.dim_rows(cdc.split_routes(routed)["dim"], ("id", "name", "nation", "acctbal"), "dim_user_info")
    return cdc.upsert_dimension(current, rows)


def q_user_snapshot_state(spark, sf):
    """SRC-4: yesterday's snapshot of the users, then their change records."""
    c = Catalog(spark, sf)
    snapshot = c.customer.select(F.col("c_custkey").alias("id"), F.lit("old").alias("name"))
    changes = cdc.flatten_changes(A.user_changes(c.customer)).where(F.col("type") == "update")
    st = cdc.snapshot_then_changes(snapshot, changes, table="user_info")
    return st.select(F.col("data")["id"].cast("long").alias("id"), F.col("data")["name"].alias("name"),
                     F.col("data")["acctbal"].alias("acctbal"), "seq")


def q_order_current_view(spark, sf):
    """SRC-5: the current orders as a SQL view, counted by status."""
    cdc.register_current_state(_changes(spark, sf), "order_info_current", ["id", "order_status"], table="order_info")
    return spark.sql("SELECT order_status, count(*) AS n FROM order_info_current GROUP BY order_status")


def q_daily_unique_visit_zone(spark, sf):
    """ST-2 with the days of UTC+8, as the reference's servers count them."""
    uv = visits.daily_unique_visit(_page_log(spark, sf), zone="Asia/Shanghai")
    return uv.select("seq", F.col("common.mid").alias("mid"), "ts")


REPORT_DAY = "2024-01-05"


def q_visitor_day(spark, sf):
    """SRC-6 + PRJ-13 + SO-2: the statistics table is written by day; the report
    reads one day's folder and is ordered by hour."""
    import os
    import uuid

    from retailstream.session import ensure_checkpoint_dir
    from retailstream.sources import sinks
    from retailstream.sources.tables import read_stats
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", f"visitor_stats-{uuid.uuid4().hex}")
    vs = visitor_stats_df(Catalog(spark, sf))
    sinks.write_stats(vs, path, [c for c in vs.columns if c != "dt"])
    return reports.visitors_by_hour(read_stats(spark, path, REPORT_DAY), date=REPORT_DAY)


def q_search_times(spark, sf):
    """FN-1, FN-5 and FN-13 over the search log."""
    from retailstream.functions import timefmt
    from retailstream.sources import sinks
    log = A.search_log(Catalog(spark, sf).conversations).select("seq", "ts", F.col("page.item_type").alias("item_type"))
    local = timefmt.ms_to_string(F.col("ts") + 1234, "Asia/Shanghai")
    rows = log.select("seq", local.alias("local"), timefmt.string_to_ms(local, "Asia/Shanghai").alias("back"),
                      timefmt.ts_string(timefmt.seconds_trunc(F.col("ts") + 1234)).alias("utc"))
    json = sinks.to_json_value(rows, ["seq", "local"])
    return json.select(F.get_json_object("value", "$.seq").cast("long").alias("seq"),
                       F.get_json_object("value", "$.local").alias("local")).join(rows.drop("local"), "seq")


def q_order_wide_merge(spark, sf):
    """PRJ-15: rows that lost their status, filled from the orders themselves."""
    c = Catalog(spark, sf)
    left = order_core_df(c).withColumn("order_status", F.when(F.col("order_id") % 2 == 0, F.col("order_status")))
    right = A.order_info(c.orders, c.customer).select(
        F.col("id").alias("order_id"), "order_status", F.lit(-1).cast("long").alias("province_id"),
        F.lit("unnamed").alias("sku_name"))
    return orders.merge_order_wide(left, right).select("order_id", "detail_id", "order_status", "province_id", "sku_name",
                                                       "split_coupon_amount")


QUERIES.update({
    "order_wide_merge": q_order_wide_merge,
    "dim_upsert_partial": q_dim_upsert_partial,
    "user_snapshot_state": q_user_snapshot_state,
    "order_current_view": q_order_current_view,
    "daily_unique_visit_zone": q_daily_unique_visit_zone,
    "visitor_day": q_visitor_day,
    "search_times": q_search_times,
})


# ---------------------------------------------------------------------------
# dimension store, config over time, retractions
# ---------------------------------------------------------------------------

N_BATCHES = 4   # that the change feed comes in


def q_dim_upsert_batches(spark, sf):
    """SNK-3: the change feed in several batches, by ranges of ``seq``, into a dimension table of
    buckets and runs; compacted on the way."""
    import os
    import uuid

    from retailstream.session import ensure_checkpoint_dir
    from retailstream.sources import dimstore
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", f"dim_user_info-{uuid.uuid4().hex}")
    rows = cdc.dim_rows(_dim_changes(spark, sf, cdc.table_process(spark, PARTIAL_ROUTING)),
                        ("id", "name", "nation", "acctbal"), "dim_user_info")
    dimstore.create(spark, path, ["id", "name", "nation"], n_buckets=8)
    last = rows.agg(F.max("seq")).first()[0] or 0
    step = last // N_BATCHES + 1
    for i in range(N_BATCHES):
        dimstore.apply(spark, rows.where(F.col("seq").between(i * step, (i + 1) * step - 1)), path, token=i)
        dimstore.compact(spark, path, least_runs=3)
    return dimstore.read(spark, path)


# The routing config as its own change feed: columns change, a config goes and another comes.
_CONFIG_KEYS = ("sourceTable", "operateType", "sinkType", "sinkTable", "sinkColumns", "sinkPk")
CONFIG_SNAPSHOT = [
    ("user_info", "insert", "hbase", "dim_user_info", "id,name,nation", "id"),
]
CONFIG_FEED = [
    ("c", ("order_info", "insert", "kafka", "dwd_order_info", "id,user_id,total_amount,order_status", "id"), 400),
    ("c", ("user_info", "update", "hbase", "dim_user_info", "id,acctbal", "id"), 800),
    ("c", ("order_info", "update", "clickhouse", "order_status_stats", "id,order_status", "id"), 1000),
    ("u", ("order_info", "insert", "kafka", "dwd_order_info", "id,order_status", "id"), 2400),
    ("u", ("order_info", "update", "kafka", "order_status_stats", "id,order_status", "id"), 3000),
    ("d", ("order_info", "insert", "kafka", "dwd_order_info", "id,order_status", "id"), 4000),
    ("c", ("order_info", "insert", "kafka", "dwd_order_new", "id,total_amount", "id"), 5000),
]


def config_over_time(spark) -> DataFrame:
    image = lambda row: dict(zip(_CONFIG_KEYS, row, strict=True))
    feed = [("erp.cfg.table_process", op, image(r) if op != "c" else None, image(r) if op != "d" else None, seq)
            for op, r, seq in CONFIG_FEED]
    changes = cdc.flatten_changes(spark.createDataFrame(
        feed, "topic string, op string, before map<string,string>, after map<string,string>, seq long"))
    return cdc.config_intervals(changes, cdc.table_process(spark, [(*r, None) for r in CONFIG_SNAPSHOT]))


def q_cdc_route_as_of(spark, sf):
    """JN-1 + PRJ-7: records routed by the config that was valid when they came."""
    r = cdc.route_changes_as_of(cdc.drop_deletes(_changes(spark, sf)), config_over_time(spark))
    return r.select("seq", F.col("tableName").alias("table_name"), "type", "route", "sink_type", "sink_table",
                    F.array_join(F.array_sort(F.map_keys("data")), ",").alias("cols"),
                    F.col("data")["id"].alias("data_id"))


def q_changelog_retractions(spark, sf):
    """CDC-2: the whole feed as images taken back and given."""
    r = cdc.changelog_retractions(_changes(spark, sf))
    return r.select(F.col("tableName").alias("table_name"), "pk", "seq", "kind",
                    F.col("data")["order_status"].alias("order_status"), F.col("data")["acctbal"].alias("acctbal"),
                    F.size("data").alias("n_data"))


QUERIES.update({
    "dim_upsert_batches": q_dim_upsert_batches,
    "cdc_route_as_of": q_cdc_route_as_of,
    "changelog_retractions": q_changelog_retractions,
})


# ---------------------------------------------------------------------------
# pattern rules, mergeable distinct counts, dictionary words
# ---------------------------------------------------------------------------

FUNNEL_WITHIN_MS = 2 * DAY_MS
DICTIONARY_LENGTHS = (2, 5)


def funnel_steps():
    from retailstream.operators.patterns import Step
    page = F.col("page.page_id")
    return [Step(F.col("page.last_page_id").isNull()), Step(page == "good_detail"), Step(page == "purchase")]


def q_session_funnel(spark, sf):
    """ST-3 / ST-4 with parameters: entry, then a product page, then a purchase; what was reached in time."""
    from retailstream.operators import patterns
    out = patterns.outcomes(_page_log(spark, sf), funnel_steps(), F.col("common.mid"), FUNNEL_WITHIN_MS)
    return out.select("seq", F.col("common.mid").alias("mid"), "ts", "outcome", "decided_at", "reached",
                      F.get("met", F.lit(1))["seq"].alias("click_seq"), F.get("met", F.lit(2))["seq"].alias("purchase_seq"))


def q_brand_paid_orders(spark, sf):
    """AG-2 / AG-8: paid orders by brand and month, each once, from the sets of order ids that are kept
    beside the daily rows of the SKUs."""
    import uuid

    from retailstream.operators import distinct
    from retailstream.sources.tables import materialize
    c = Catalog(spark, sf)
    rows = stats.payment_rows(pay_orders(order_core_df(c), c)).withColumn("dt", F.date_format(stats.event_time("ts"), "yyyy-MM-dd"))
    daily = materialize(distinct.containers(rows, ["dt", "sku_id"], "paid_oid"), f"paid_orders-{uuid.uuid4().hex}")
    brands = A.dim_sku_info(c.part).select(F.col("id").alias("_sku"), "tm_id")
    monthly = (daily.join(brands, F.col("sku_id").cast("string") == F.col("_sku"))
               .withColumn("month", F.substring("dt", 1, 7)))
    by = ["month", "tm_id"]
    return distinct.count(distinct.merge(monthly, by), by, "paid_order_ct")


def q_dictionary_keywords(spark, sf):
    """UDT-1 with a user dictionary: words of the searches, cut at the short words of the replies."""
    from retailstream.functions.keywords import tokenize
    from retailstream.operators import segment
    log = A.search_log(Catalog(spark, sf).conversations)
    replies = log.where(F.col("page.item_type") == "reply").select(F.explode(tokenize(F.col("page.item"))).alias("word"))
    low, high = DICTIONARY_LENGTHS
    words = segment.dictionary_keywords(stats.search_rows(log), replies.where(F.length("word").between(low, high)), max_len=high)
    return words.groupBy("keyword", "known").agg(F.count(F.lit(1)).alias("ct"))


QUERIES.update({
    "session_funnel": q_session_funnel,
    "brand_paid_orders": q_brand_paid_orders,
    "dictionary_keywords": q_dictionary_keywords,
})
