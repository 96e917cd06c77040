"""Structured Streaming jobs: the reference's DWD -> DWM -> DWS layers, each a
query that reads topics (Kafka or files), applies the same operators as the
batch plans, and writes idempotently per micro-batch.

Every ``start_*`` function returns a started ``StreamingQuery``; the caller
passes a ``checkpoint`` folder (mandatory: restart resumes from it, CK-1).
Parameters default to the reference's constants (10 s windows, 1/2/10 s
watermarks, +-5 s and -15 min/+2 s join bounds).
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType

from retailstream.functions.timefmt import parse_ts
from retailstream.operators import cdc, dims, logs, orders, stats
from retailstream.schemas import COMMON, DISPLAY
from retailstream.sources import commits, sinks
from retailstream.sources.topics import event_time_or_ingest
from retailstream.streaming import processors as P

VISITOR_COLUMNS = ("stt", "edt", "vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts")


def _start(df: DataFrame, name: str, checkpoint: str, batch_fn: Callable[[DataFrame, int, str], None],
           trigger: dict | None = None, output_mode: str = "append") -> StreamingQuery:
    """Start a query whose micro-batches go to ``batch_fn(rows, batch id, query id)``.

    The query id is kept in the checkpoint, so it tells runs with different
    checkpoints apart; a batch waits for it when it comes before ``start`` returns.
    """
    started, known = threading.Event(), []

    def batch(rows: DataFrame, bid: int) -> None:
        if not started.wait(600):
            raise RuntimeError(f"{name}: the query did not start")
        batch_fn(rows, bid, known[0])
    w = df.writeStream.queryName(name).outputMode(output_mode).option("checkpointLocation", checkpoint) \
        .foreachBatch(batch)
    query = (w.trigger(**trigger) if trigger else w).start()
    known.append(str(query.id))
    started.set()
    return query


# ---------------------------------------------------------------------------
# DWD: raw log -> dirty / start / page / display topics   (PRJ-1, ST-1, PRJ-4/5)
# ---------------------------------------------------------------------------

def start_log_split(raw: DataFrame, out: str, checkpoint: str, ttl_ms: int | None = None,
                    trigger: dict | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """``raw``: stream of ``seq, value``.  Writes ``out/{dirty,start,page,display}``.

    Returns both queries: the split and the one that writes ``dirty``, which are
    the malformed lines and those without a visitor or a time (D11).
    """
    clean, dirty = logs.split_dirty(logs.parse_json(raw))
    whole = F.col("log.common.mid").isNotNull() & F.col("log.ts").isNotNull()
    flat = P.flatten_page_log(logs.flatten(clean.where(whole)), whole_common=True)
    dirty = dirty.select("seq", "value").unionByName(clean.where(~whole).select("seq", "value"))
    fixed = P.repair_new_visitor_stream(flat, ttl_ms)

    def batch(df: DataFrame, bid: int, run: str) -> None:
        # the repaired flag belongs to the record's common part too
        common = F.from_json("common", COMMON).withField("is_new", F.col("is_new"))
        df = df.withColumn("common", common).persist()
        is_start = F.col("start").isNotNull() & (F.length("start") > 0) & (F.col("start") != "null")
        sinks.write_topic(df.where(is_start).drop("page_id", "last_page_id", "item", "item_type", "during_time",
                                                  "displays"), f"{out}/start", batch_id=bid, run=run)
        pages = df.where(~is_start).drop("start")
        sinks.write_topic(pages, f"{out}/page", batch_id=bid, run=run)
        records = pages.select("seq", "common", F.struct("page_id").alias("page"),
                               F.from_json("displays", ArrayType(DISPLAY)).alias("displays"), "ts")
        sinks.write_topic(logs.explode_displays(records), f"{out}/display", batch_id=bid, run=run)
        df.unpersist()

    rejects = _start(dirty, "dwd_dirty", checkpoint + "_dirty",
                     lambda d, b, run: commits.write_batch(d, f"{out}/dirty", b, run), trigger)
    return _start(fixed, "dwd_log_split", checkpoint, batch, trigger), rejects


# ---------------------------------------------------------------------------
# DWM: unique visits and jumps   (ST-2, ST-3)
# ---------------------------------------------------------------------------

def start_unique_visit(flat_pages: DataFrame, out: str, checkpoint: str, ttl_ms: int | None = 86_400_000,
                       trigger: dict | None = None, zone: str = "UTC") -> StreamingQuery:
    uv = P.daily_unique_visit_stream(flat_pages, ttl_ms, zone)
    return _start(uv, "dwm_unique_visit", checkpoint, lambda d, b, run: sinks.write_topic(d, out, batch_id=b, run=run),
                  trigger)


def start_user_jump(flat_pages: DataFrame, out: str, checkpoint: str, within_ms: int = 10_000,
                    delay: str = "1 second", trigger: dict | None = None) -> StreamingQuery:
    uj = P.bounce_detect_stream(flat_pages, within_ms, delay)
    return _start(uj, "dwm_user_jump", checkpoint, lambda d, b, run: sinks.write_topic(d, out, batch_id=b, run=run),
                  trigger)


# ---------------------------------------------------------------------------
# DWS: visitor stats   (PRJ-10, SET-1, WM-2, AG-1, SNK-5)
# ---------------------------------------------------------------------------

def _watermarked(df: DataFrame, delay: str) -> DataFrame:
    return df.withColumn("rt", F.timestamp_millis("ts")).withWatermark("rt", delay)


def _union_watermarked(parts: list[DataFrame], delay: str) -> DataFrame:
    """Watermark every input before the union: Spark then keeps one watermark
    per input and advances the query's watermark by their minimum, so a fast
    input cannot make a slow one's rows late (the union semantics of the
    reference's engine)."""
    out = None
    for p in parts:
        w = _watermarked(p, delay)
        out = w if out is None else out.unionByName(w, allowMissingColumns=True)
    return out


def visitor_stats_stream(pages: DataFrame, uv: DataFrame, uj: DataFrame, window: str = "10 seconds",
                         delay: str = "30 seconds") -> DataFrame:
    """Union of the three flat page streams -> watermark -> tumbling window.
    The default delay is raised from 10 s to 30 s because jump rows arrive
    >= 10 s after their event time (D3)."""
    dt = "array<struct<item:string,item_type:string>>"
    nest = lambda d: P.nest_page_log(d, dt)
    rows = _union_watermarked(stats.visitor_measure_parts(nest(pages), nest(uv), nest(uj)), delay)
    return stats.visitor_stats(rows, window, streaming=True)


def start_visitor_stats(pages: DataFrame, uv: DataFrame, uj: DataFrame, out: str, checkpoint: str,
                        window: str = "10 seconds", delay: str = "30 seconds",
                        trigger: dict | None = None) -> StreamingQuery:
    vs = visitor_stats_stream(pages, uv, uj, window, delay)
    return _start(vs, "dws_visitor_stats", checkpoint,
                  lambda d, b, run: sinks.write_stats(d, out, VISITOR_COLUMNS, batch_id=b, run=run), trigger)


# ---------------------------------------------------------------------------
# DWS: keyword stats   (PRJ-9, JN-5, AG-4, WM-3)
# ---------------------------------------------------------------------------

KEYWORD_COLUMNS = ("keyword", "ct", "source", "stt", "edt", "ts")


def keyword_stats_stream(pages: DataFrame, window: str = "10 seconds", delay: str = "2 seconds") -> DataFrame:
    """PRJ-9 -> JN-5 -> AG-4 on a stream of page rows (``page``, ``ts``)."""
    words = stats.explode_keywords(_watermarked(stats.search_rows(pages), delay))
    return stats.keyword_stats(words, window, streaming=True)


def start_keyword_stats(pages: DataFrame, out: str, checkpoint: str, window: str = "10 seconds",
                        delay: str = "2 seconds", trigger: dict | None = None) -> StreamingQuery:
    return _start(keyword_stats_stream(pages, window, delay), "dws_keyword_stats", checkpoint,
                  lambda d, b, run: sinks.write_stats(d, out, KEYWORD_COLUMNS, batch_id=b, run=run), trigger)


# ---------------------------------------------------------------------------
# DWM: order wide / payment wide   (JN-2, JN-3, WM-1, JN-4)
# ---------------------------------------------------------------------------

def order_wide_stream(order_info: DataFrame, order_detail: DataFrame, lower: str = "-5 seconds",
                      upper: str = "5 seconds", delay: str = "0 seconds") -> DataFrame:
    """Stream-stream interval join with watermarks on both sides (state is
    purged once the watermark passes the bounds)."""
    o = orders.order_time_fields(order_info)
    o = o.withColumn("rt", F.timestamp_millis("create_ts")).withWatermark("rt", delay)
    d = orders.with_event_ms(order_detail, out="_d_ts").withColumn("rt", F.timestamp_millis("_d_ts")) \
        .withWatermark("rt", delay).drop("_d_ts")
    return orders.order_wide(o, d, lower, upper, streaming=True)


def start_order_wide(order_info: DataFrame, order_detail: DataFrame, load_dims: Callable[[], dict], out: str,
                     checkpoint: str, as_of=None, trigger: dict | None = None, **bounds) -> StreamingQuery:
    """Dimensions are re-read by ``load_dims()`` in every micro-batch, so
    upserted dimension rows are seen (D6); lookups are left joins (D5).  A
    loader built on ``Catalog`` should pass ``cache=False`` so each call lists
    the folder again."""
    ow = order_wide_stream(order_info, order_detail, **bounds)

    def batch(df: DataFrame, bid: int, run: str) -> None:
        dm = load_dims()
        x = dims.enrich_user(df, dm["user"], as_of if as_of is not None else F.current_timestamp())
        x = dims.enrich_province(x, dm["province"])
        x = dims.enrich_product(x, dm["sku"], dm["spu"], dm["trademark"], dm["category3"])
        sinks.write_topic(x.drop("rt"), out, batch_id=bid, run=run)

    return _start(ow, "dwm_order_wide", checkpoint, batch, trigger)


def payment_wide_stream(payment_info: DataFrame, order_wide_rows: DataFrame, lower: str = "-15 minutes",
                        upper: str = "2 seconds", delay: str = "0 seconds") -> DataFrame:
    """JN-3 on streams: payments (event time = payment create time, falling back
    to ``ingest_time`` when unparseable and that column is there, WM-4) joined to
    order-wide rows."""
    at = event_time_or_ingest("create_time") if "ingest_time" in payment_info.columns \
        else parse_ts("create_time").cast("timestamp")
    p = payment_info.withColumn("rt", at).withColumn("payment_ts", F.unix_millis("rt")).withWatermark("rt", delay)
    w = order_wide_rows.withColumn("rt", F.timestamp_millis("create_ts")).withWatermark("rt", delay)
    return orders.payment_wide(p, w, lower, upper, streaming=True)


def start_payment_wide(payment_info: DataFrame, order_wide_rows: DataFrame, out: str, checkpoint: str,
                       trigger: dict | None = None, **bounds) -> StreamingQuery:
    pw = payment_wide_stream(payment_info, order_wide_rows, **bounds)
    return _start(pw, "dwm_payment_wide", checkpoint,
                  lambda d, b, run: sinks.write_topic(d.drop("rt"), out, batch_id=b, run=run), trigger)


# ---------------------------------------------------------------------------
# DWS: province stats   (AG-3)
# ---------------------------------------------------------------------------

PROVINCE_COLUMNS = ("stt", "edt", *stats.PROVINCE_KEYS, "order_amount", "order_count", "ts")


def province_stats_stream(order_wide_rows: DataFrame, window: str = "10 seconds",
                          delay: str = "2 seconds") -> DataFrame:
    """AG-3 on order-wide rows (``create_ts``)."""
    rows = order_wide_rows.withColumn("rt", F.timestamp_millis("create_ts")).withWatermark("rt", delay)
    return stats.province_stats(rows, window, streaming=True)


def start_province_stats(order_wide_rows: DataFrame, out: str, checkpoint: str, window: str = "10 seconds",
                         delay: str = "2 seconds", trigger: dict | None = None) -> StreamingQuery:
    return _start(province_stats_stream(order_wide_rows, window, delay), "dws_province_stats", checkpoint,
                  lambda d, b, run: sinks.write_stats(d, out, PROVINCE_COLUMNS, batch_id=b, run=run), trigger)


# ---------------------------------------------------------------------------
# DWS: product stats   (SET-2, AG-2 with collect_set distinct, JN-4c..f)
# ---------------------------------------------------------------------------

PRODUCT_COLUMNS = ("stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name", "tm_id", "tm_name",
                   "category3_id", "category3_name", *stats.PRODUCT_COUNTS, *stats.PRODUCT_AMOUNTS,
                   "order_ct", "paid_order_ct", "refund_order_ct", "ts")


def product_stats_stream(parts: list[DataFrame], window: str = "10 seconds", delay: str = "2 seconds") -> DataFrame:
    rows = stats.union_product_rows([_watermarked(p, delay) for p in parts])
    return stats.product_stats(rows, window, streaming=True)


def start_product_stats(parts: list[DataFrame], load_dims: Callable[[], dict], out: str, checkpoint: str,
                        window: str = "10 seconds", delay: str = "2 seconds",
                        trigger: dict | None = None) -> StreamingQuery:
    ps = product_stats_stream(parts, window, delay)

    def batch(df: DataFrame, bid: int, run: str) -> None:
        dm = load_dims()
        x = dims.enrich_product(df, dm["sku"], dm["spu"], dm["trademark"], dm["category3"], with_price=True)
        sinks.write_stats(x, out, PRODUCT_COLUMNS, batch_id=bid, run=run)

    return _start(ps, "dws_product_stats", checkpoint, batch, trigger)


# ---------------------------------------------------------------------------
# ODS/DWD: change feed -> facts and dimensions   (CDC-1, PRJ-3, JN-1, PRJ-6/7, SNK-2/3)
# ---------------------------------------------------------------------------

def start_change_router(envelopes: DataFrame, load_config: Callable[[], DataFrame], facts_out: str,
                        dims_root: str, rejects_out: str, checkpoint: str,
                        trigger: dict | None = None) -> StreamingQuery:
    """The routing config is re-read every micro-batch (the reference's
    broadcast config stream): ``load_config`` gives it as it stands, or over time
    (``cdc.config_intervals``), and then each record is routed by the config that was
    valid when it came, on a re-run of old records too.  Facts go to per-table
    topics, dimension rows are upserted into ``dims_root/<sink_table>`` (created on
    first use with the config's columns), unmatched rows go to a reject output."""
    changes = cdc.drop_deletes(cdc.flatten_changes(envelopes))

    def batch(df: DataFrame, bid: int, run: str) -> None:
        cfg = load_config()
        route, configs = ((cdc.route_changes_as_of, cfg) if "valid_from" in cfg.columns
                          else (cdc.route_changes, cdc.latest_config(cfg)))
        routed = route(df, cfg).persist()
        r = cdc.split_routes(routed)
        sinks.write_routed(r["fact"], facts_out, batch_id=bid, run=run)
        rej = routed.where(F.col("route").isin("no_config", "unknown_sink"))
        commits.write_batch(rej.select("route", "tableName", "type", "seq", F.to_json("data").alias("data")),
                            rejects_out, bid, run)
        spark = df.sparkSession
        # one row for each dimension table, with the columns of all its configs
        tables = (configs.where(F.col("sinkType") == cdc.SINK_DIM)
                  .select("sinkTable", "sinkPk", F.explode(F.split("sinkColumns", ",")).alias("c"))
                  .groupBy("sinkTable").agg(F.max("sinkPk").alias("pk"), F.sort_array(F.collect_set("c")).alias("cols")))
        for row in tables.collect():
            schema = cdc.dim_schema(",".join(row["cols"]), row["pk"])
            path = f"{dims_root}/{row['sinkTable']}"
            sinks.ensure_dim_table(spark, path, schema, row["pk"])
            rows = cdc.dim_rows(r["dim"], schema.fieldNames(), row["sinkTable"])
            sinks.upsert_dimension_table(spark, rows, path, pk=row["pk"] or "id", token=f"{run}:{bid}")
        routed.unpersist()

    return _start(changes, "dwd_change_router", checkpoint, batch, trigger)
