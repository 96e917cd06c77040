"""Batch build of the whole warehouse over the supplied tables, layer by layer
(DWD -> DWM -> DWS), the way the streaming jobs connect through topics: each
layer is written as a table and read back (lineage cut), statistics tables are
partitioned by ``dt`` for the reports."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from retailstream.operators import stats, visits
from retailstream.plans import queries as Q
from retailstream.sources import adapters as A
from retailstream.sources import sinks
from retailstream.sources.tables import Catalog, materialize
from retailstream.streaming.jobs import PRODUCT_COLUMNS, VISITOR_COLUMNS

PROVINCE_COLUMNS = ("stt", "edt", *stats.PROVINCE_KEYS, "order_amount", "order_count", "ts")
KEYWORD_COLUMNS = ("keyword", "ct", "source", "stt", "edt", "ts")


def build_warehouse(spark: SparkSession, sf_dir: str, out: str) -> dict[str, str]:
    """Run every layer; return the paths of the four statistics tables."""
    c = Catalog(spark, sf_dir)
    layer = lambda df, name: materialize(df, name, os.path.join(out, "layers"))

    # DWD: the page-log adapter's rows are the DWD page log (FIXTURES: its is_new
    # flags are final); the raw-log route parse -> repair (ST-1) -> split is
    # the registered dirty_split / start_page_split / display_explode queries.
    pages = layer(A.page_log(c.events), "dwd_page_log")
    # DWM: unique visits, jumps, order wide, payment wide
    uv = layer(visits.daily_unique_visit(pages), "dwm_unique_visit")
    uj = layer(visits.bounce_detect(pages, within_ms=Q.BOUNCE_WITHIN_MS), "dwm_user_jump")
    ow = layer(Q.order_wide_df(c), "dwm_order_wide")
    pw = layer(Q.pay_orders(ow, c), "dwm_payment_wide")

    # DWS: statistics tables
    paths = {k: os.path.join(out, k) for k in ("visitor_stats", "product_stats", "province_stats",
                                               "keyword_stats")}
    vs = stats.visitor_stats(stats.visitor_measure_rows(pages, uv, uj), window=Q.VISITOR_WINDOW)
    sinks.write_stats(vs, paths["visitor_stats"], VISITOR_COLUMNS)

    ps = stats.product_stats(Q.product_measure_rows(pages, ow, pw, c), window=Q.PRODUCT_WINDOW)
    ps = Q.enrich_product(ps, c, with_price=True)
    sinks.write_stats(ps, paths["product_stats"], PRODUCT_COLUMNS)

    prov = stats.province_stats(ow, window=Q.PROVINCE_WINDOW, as_of_s=F.lit(Q.AS_OF_S))
    sinks.write_stats(prov, paths["province_stats"], PROVINCE_COLUMNS)

    words = stats.explode_keywords(stats.search_rows(A.search_log(c.conversations)))
    kw = stats.keyword_stats(words, window=Q.KEYWORD_WINDOW, as_of_s=F.lit(Q.AS_OF_S))
    sinks.write_stats(kw, paths["keyword_stats"], KEYWORD_COLUMNS)
    return paths
