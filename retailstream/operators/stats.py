"""DWS statistics: measure rows (PRJ-9..12), unions (SET-1/2) and event-time
tumbling-window aggregates (AG-1..4).

Every aggregate here is a ``groupBy(window(...), keys).agg(...)``: Spark plans it
as partial (map-side) + final hash aggregation, so a hot key is pre-combined in
every task before the shuffle.  The same functions run on streaming DataFrames
(after ``withWatermark``); ``count(distinct)`` is refused on streams, so there the
ids are de-duplicated within their window first and then counted.  ``stt`` and
``edt`` are wall-clock times of ``zone``, in both forms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from retailstream.functions.keywords import KEYWORD_SEARCH, tokenize
from retailstream.functions.timefmt import from_epoch_ms, window_bounds

SUM_MONEY = DecimalType(38, 2)


def split_rejects(rows: DataFrame, keys: Sequence[str], ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """D11: rows with a null event time or a null grouping key cannot be placed
    in a window (the reference would fail on them); they go to a reject output
    instead of forming a null group."""
    bad = F.col(ts).isNull()
    for k in keys:
        bad = bad | F.col(k).isNull()
    return rows.where(~bad), rows.where(bad)


def event_time(ms: Column | str = "ts", streaming: bool = False) -> Column:
    """Event-time column for windows: NTZ from epoch ms in batch; on streams
    the watermarked ``rt`` column the job attached (``withWatermark("rt", …)``),
    which append-mode windows require."""
    if streaming:
        return F.col("rt")
    return from_epoch_ms(F.col(ms) if isinstance(ms, str) else ms)


# ---------------------------------------------------------------------------
# visitor stats (PRJ-10, SET-1, AG-1)
# ---------------------------------------------------------------------------

VISITOR_KEYS = ("vc", "ch", "ar", "is_new")
VISITOR_MEASURES = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")


def _visitor_rows(df: DataFrame, uv: int, pv: int, uj: int, sv: Column | None, dur: Column | None) -> DataFrame:
    return df.select(
        *[F.col(f"common.{k}").alias(k) for k in VISITOR_KEYS],
        F.lit(uv).cast("long").alias("uv_ct"), F.lit(pv).cast("long").alias("pv_ct"),
        (sv if sv is not None else F.lit(0)).cast("long").alias("sv_ct"),
        F.lit(uj).cast("long").alias("uj_ct"),
        (dur if dur is not None else F.lit(0)).cast("long").alias("dur_sum"),
        F.col("ts"))


def visitor_measure_parts(page_log: DataFrame, unique_visits: DataFrame, jumps: DataFrame) -> list[DataFrame]:
    """PRJ-10: UV rows (uv=1), jump rows (uj=1) and page rows (pv=1,
    sv = entry page, dur = during_time)."""
    uv = _visitor_rows(unique_visits, 1, 0, 0, None, None)
    uj = _visitor_rows(jumps, 0, 0, 1, None, None)
    pv = _visitor_rows(page_log, 0, 1, 0,
                       F.when(F.col("page.last_page_id").isNull(), 1).otherwise(0),
                       F.coalesce(F.col("page.during_time"), F.lit(0)))  # D11: null measure -> 0
    return [uv, uj, pv]


def visitor_measure_rows(page_log: DataFrame, unique_visits: DataFrame, jumps: DataFrame) -> DataFrame:
    """PRJ-10 + SET-1: the three measure-row streams unioned by name."""
    uv, uj, pv = visitor_measure_parts(page_log, unique_visits, jumps)
    return uv.unionByName(uj).unionByName(pv)


def visitor_stats(rows: DataFrame, window: str = "10 seconds", streaming: bool = False,
                  zone: str = "UTC") -> DataFrame:
    """AG-1: per (window, vc, ch, ar, is_new) sums; ``ts`` = earliest event ms (D10).
    Rows without event time are left out (see ``split_rejects``)."""
    rows = rows.where(F.col("ts").isNotNull())
    g = rows.groupBy(F.window(event_time("ts", streaming), window).alias("window"), *VISITOR_KEYS).agg(
        *[F.sum(m).alias(m) for m in VISITOR_MEASURES], F.min("ts").alias("ts"))
    return g.select(*window_bounds(streaming=streaming, zone=zone), *VISITOR_KEYS, *VISITOR_MEASURES, "ts")


# ---------------------------------------------------------------------------
# product stats (PRJ-11, PRJ-12a..f, SET-2, AG-2)
# ---------------------------------------------------------------------------

PRODUCT_COUNTS = ("display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num",
                  "comment_ct", "good_comment_ct")
PRODUCT_AMOUNTS = ("order_amount", "payment_amount", "refund_amount")
APPRAISE_GOOD = "1201"  # fixed value: business code of a good comment


def click_display_rows(page_log: DataFrame) -> DataFrame:
    """PRJ-11: a detail page of a SKU is a click; each SKU display is a display.
    Display rows take ``page_id`` from ``common`` when present, else ``page`` (D1)."""
    clicks = page_log.where((F.col("page.page_id") == "good_detail") & (F.col("page.item_type") == "sku_id")) \
        .select(F.col("page.item").cast("long").alias("sku_id"), F.lit(1).cast("long").alias("click_ct"),
                F.col("ts"))
    disp = page_log.where(F.col("displays").isNotNull()) \
        .select(F.explode("displays").alias("d"), "ts") \
        .where(F.col("d.item_type") == "sku_id") \
        .select(F.col("d.item").cast("long").alias("sku_id"), F.lit(1).cast("long").alias("display_ct"),
                F.col("ts"))
    return clicks.unionByName(disp, allowMissingColumns=True)


def favor_rows(favor: DataFrame) -> DataFrame:
    """PRJ-12a."""
    return favor.select("sku_id", F.lit(1).cast("long").alias("favor_ct"), "ts")


def cart_rows(cart: DataFrame) -> DataFrame:
    """PRJ-12b."""
    return cart.select("sku_id", F.lit(1).cast("long").alias("cart_ct"), "ts")


def order_rows(order_wide: DataFrame, amount_col: str = "total_amount") -> DataFrame:
    """PRJ-12c: sku_num, amount and order id per order-wide row.  The default
    amount is the order-level ``total_amount`` once per detail line (D8);
    pass ``amount_col='split_total_amount'`` for the per-line amount."""
    return order_wide.select("sku_id", F.col("sku_num").alias("order_sku_num"),
                             F.col(amount_col).cast(SUM_MONEY).alias("order_amount"),
                             F.col("order_id").alias("order_oid"), F.col("create_ts").alias("ts"))


def payment_rows(payment_wide: DataFrame) -> DataFrame:
    """PRJ-12d: payment amount and paid order id, at payment create time."""
    return payment_wide.select("sku_id", F.col("total_amount").cast(SUM_MONEY).alias("payment_amount"),
                               F.col("order_id").alias("paid_oid"), F.col("payment_ts").alias("ts"))


def refund_rows(refund: DataFrame) -> DataFrame:
    """PRJ-12e."""
    return refund.select("sku_id", F.col("refund_amount").cast(SUM_MONEY).alias("refund_amount"),
                         F.col("order_id").alias("refund_oid"), "ts")


def comment_rows(comment: DataFrame) -> DataFrame:
    """PRJ-12f: comment=1, good=1 iff appraise is the good code."""
    return comment.select("sku_id", F.lit(1).cast("long").alias("comment_ct"),
                          F.when(F.col("appraise") == APPRAISE_GOOD, 1).otherwise(0).cast("long")
                          .alias("good_comment_ct"), "ts")


def union_product_rows(parts: Sequence[DataFrame]) -> DataFrame:
    """SET-2: union by name; missing measures default to 0 (ids stay null)."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    for c in PRODUCT_COUNTS:
        u = u.withColumn(c, F.coalesce(F.col(c) if c in u.columns else F.lit(None), F.lit(0)).cast("long"))
    for c in PRODUCT_AMOUNTS:
        u = u.withColumn(c, F.coalesce(F.col(c) if c in u.columns else F.lit(None),
                                       F.lit(0)).cast(SUM_MONEY))
    for c in ("order_oid", "paid_oid", "refund_oid"):
        if c not in u.columns:
            u = u.withColumn(c, F.lit(None).cast("long"))
    return u


def _kind_and_id() -> tuple[Column, Column]:
    """Each measure row carries at most one order id: of an order, a payment or a refund."""
    kind = (F.when(F.col("order_oid").isNotNull(), "o").when(F.col("paid_oid").isNotNull(), "p")
            .when(F.col("refund_oid").isNotNull(), "r"))
    return kind, F.coalesce("order_oid", "paid_oid", "refund_oid")


def _first_of_each(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per value of ``keys`` (with the watermarked ``window``), for exact
    distinct counts on streams: each id is a small state row of its own that goes
    with its window, instead of one set that holds all ids of a group."""
    return rows.select(*keys).dropDuplicates(list(keys))


def product_stats(rows: DataFrame, window: str = "10 seconds", streaming: bool = False,
                  zone: str = "UTC") -> DataFrame:
    """AG-2: per (window, sku_id) sums and exact distinct order / paid / refunded
    order counts; ``ts`` = earliest event ms.

    Batch: each measure row carries at most one order id (order, payment or
    refund row), so the three distinct counts are one two-level aggregation —
    first per (window, sku, id kind, id), then per (window, sku) counting ids by
    kind — instead of Spark's expand-based rewrite of three ``count(distinct)``
    (which copies every row four times).  Both levels pre-aggregate map-side.
    """
    rows = rows.where(F.col("ts").isNotNull() & F.col("sku_id").isNotNull())  # D11: see split_rejects
    kind, oid = _kind_and_id()
    out = [*window_bounds(streaming=streaming, zone=zone), "sku_id", *PRODUCT_COUNTS, *PRODUCT_AMOUNTS, "order_ct", "paid_order_ct",
           "refund_order_ct", "ts"]
    sums = [*[F.sum(c).alias(c) for c in PRODUCT_COUNTS],
            *[F.sum(c).cast(SUM_MONEY).alias(c) for c in PRODUCT_AMOUNTS], F.min("ts").alias("ts")]
    counted = {"o": "order_ct", "p": "paid_order_ct", "r": "refund_order_ct"}   # nulls are not counted (D12)
    if streaming:
        placed = rows.withColumns({"window": F.window(event_time("ts", True), window), "_kind": kind, "_oid": oid})
        marks = _first_of_each(placed.where(F.col("_oid").isNotNull()), ["window", "sku_id", "_kind", "_oid"])
        both = placed.select("window", "sku_id", *PRODUCT_COUNTS, *PRODUCT_AMOUNTS, "ts").unionByName(
            marks.select("window", "sku_id", "_kind"), allowMissingColumns=True)
        g = both.groupBy("window", "sku_id").agg(
            *sums, *[F.count(F.when(F.col("_kind") == k, 1)).alias(c) for k, c in counted.items()])
        return g.select(*out)
    lvl1 = rows.groupBy(F.window(event_time("ts"), window).alias("window"), "sku_id",
                        kind.alias("_kind"), oid.alias("_oid")).agg(
        *[F.sum(c).alias(c) for c in PRODUCT_COUNTS], *[F.sum(c).alias(c) for c in PRODUCT_AMOUNTS],
        F.min("ts").alias("ts"))
    g = lvl1.groupBy("window", "sku_id").agg(
        *sums, *[F.count(F.when(F.col("_kind") == k, F.col("_oid"))).alias(c) for k, c in counted.items()])
    return g.select(*out)


# ---------------------------------------------------------------------------
# province stats (AG-3)
# ---------------------------------------------------------------------------

PROVINCE_KEYS = ("province_id", "province_name", "province_area_code", "province_iso_code",
                 "province_3166_2_code")


def province_stats(order_wide: DataFrame, window: str = "10 seconds", as_of_s: Column | None = None,
                   amount_col: str = "total_amount", streaming: bool = False, zone: str = "UTC",
                   keys: Sequence[str] = PROVINCE_KEYS) -> DataFrame:
    """AG-3: per (window, province) ``sum(amount)`` (D8 default: order total per
    detail line) and distinct orders; ``ts`` = processing seconds (``as_of_s``).
    ``keys``: the province's columns; the id alone where its names are looked up
    after the aggregation."""
    amount = F.col(amount_col).cast(SUM_MONEY).alias("amount")
    if streaming:
        placed = order_wide.select(F.window(event_time("create_ts", True), window).alias("window"), *keys,
                                   "order_id", amount)
        marks = _first_of_each(placed.where(F.col("order_id").isNotNull()), ["window", *keys, "order_id"])
        both = placed.drop("order_id").unionByName(marks, allowMissingColumns=True)
        g = both.groupBy("window", *keys).agg(
            F.sum("amount").cast(SUM_MONEY).alias("order_amount"), F.count("order_id").alias("order_count"))
    else:
        g = order_wide.groupBy(F.window(event_time("create_ts"), window).alias("window"), *keys).agg(
            F.sum(amount).cast(SUM_MONEY).alias("order_amount"), F.count_distinct("order_id").alias("order_count"))
    ts = as_of_s if as_of_s is not None else F.unix_timestamp()
    return g.select(*window_bounds(streaming=streaming, zone=zone), *keys, "order_amount", "order_count",
                    ts.cast("long").alias("ts"))


# ---------------------------------------------------------------------------
# keyword stats (PRJ-9, JN-5, AG-4)
# ---------------------------------------------------------------------------

def search_rows(page_log: DataFrame) -> DataFrame:
    """PRJ-9: search pages (``item_type='keyword'`` with an item) -> ``full_word, ts``."""
    return page_log.where((F.col("page.item_type") == "keyword") & F.col("page.item").isNotNull()) \
        .select(F.col("page.item").alias("full_word"), "ts")


def explode_keywords(rows: DataFrame, text: str = "full_word") -> DataFrame:
    """JN-5 (inner lateral join with the tokenizer): one row per keyword; a
    text without keywords gives no row."""
    return rows.select(F.explode(tokenize(text)).alias("keyword"), *[c for c in rows.columns if c != text])


def keyword_stats(words: DataFrame, window: str = "10 seconds", source: str = KEYWORD_SEARCH,
                  as_of_s: Column | None = None, streaming: bool = False, zone: str = "UTC") -> DataFrame:
    """AG-4: per (window, keyword) ``count(*)`` with a constant source;
    ``ts`` = processing seconds (``as_of_s``)."""
    g = words.groupBy(F.window(event_time("ts", streaming), window).alias("window"), "keyword") \
        .agg(F.count(F.lit(1)).alias("ct"))
    ts = as_of_s if as_of_s is not None else F.unix_timestamp()
    return g.select("keyword", "ct", F.lit(source).alias("source"), *window_bounds(streaming=streaming, zone=zone),
                    ts.cast("long").alias("ts"))
