"""Dashboard reports over the statistics tables (AG-5..14, SO-1/2, MET-1..3).

Each report takes an optional ``date`` ('yyyy-MM-dd').  With a date it is the
reference's one-day report (partition filter on ``dt``, ``orderBy().limit()``
planned as TakeOrderedAndProject).  Without a date it is computed for every
day at once (``dt`` becomes a grouping key; per-day top-N is
``row_number() <= n``, which Spark plans with a partial per-task group limit
before the shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailstream.functions.keywords import keyword_weight
from retailstream.functions.metrics import OUT_TYPE, visitor_ratios
from retailstream.operators.dims import enrich, enrich_province

SUM_MONEY = "decimal(38,2)"
ANY_DAY = "any"   # as a report's ``date``: the rows are those of the day already
TODAY = "today"   # as a report's ``date``: the session's current day; None: every day


def with_dt(stats: DataFrame) -> DataFrame:
    """``dt`` = day of ``stt`` (stats tables are partitioned by it)."""
    return stats if "dt" in stats.columns else stats.withColumn("dt", F.substring("stt", 1, 10))


def _day(stats: DataFrame, date: str | None) -> tuple[DataFrame, list[str]]:
    if date == ANY_DAY:
        return stats, []
    s = with_dt(stats)
    if date is None:
        return s, ["dt"]
    day = F.current_date().cast("string") if date == TODAY else F.lit(date)
    return s.where(F.col("dt") == day), []


def _top(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    if not by:
        return df.orderBy(*order).limit(n)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def gmv(product_stats: DataFrame, date: str | None = None) -> DataFrame:
    """AG-5: total order amount of the day (null when the day is empty)."""
    s, by = _day(product_stats, date)
    return s.groupBy(*by).agg(F.sum("order_amount").cast(SUM_MONEY).alias("gmv"))


def amount_top_n(product_stats: DataFrame, keys: Sequence[str], n: int = 10, date: str | None = None,
                 with_order_ct: bool = False) -> DataFrame:
    """AG-6/7/8 + SO-1: ``group by keys having order_amount > 0`` ordered by
    amount desc (keys as tie-break), first ``n``."""
    s, by = _day(product_stats, date)
    aggs = [F.sum("order_amount").cast(SUM_MONEY).alias("order_amount")]
    if with_order_ct:
        aggs.append(F.sum("order_ct").cast("long").alias("order_ct"))
    g = s.groupBy(*by, *keys).agg(*aggs).where(F.col("order_amount") > 0)
    return _top(g, by, [F.col("order_amount").desc(), *[F.col(k).asc_nulls_first() for k in keys]], n)


def amount_top_n_of(sku_stats: DataFrame, skus: DataFrame, key: str, names: DataFrame, name: str, out_name: str,
                    n: int = 10, date: str | None = None, with_order_ct: bool = False) -> DataFrame:
    """AG-6/7/8 from statistics by SKU that have no names yet: the result of ``amount_top_n`` over
    ``key, out_name``.

    Amounts are summed by day and SKU first; only then the SKU gives the ``key`` that
    the report groups by, and only the winners get their name (``name`` in ``names``,
    by ``id``).
    """
    s, by = _day(sku_stats, date)
    sums = [F.sum("order_amount").alias("order_amount"), *([F.sum("order_ct").alias("order_ct")] if with_order_ct else [])]
    by_key = enrich(s.groupBy(*by, "sku_id").agg(*sums), skus, "sku_id", {key: key})
    top = amount_top_n(by_key, [key], n, None if by else ANY_DAY, with_order_ct)
    named = enrich(top, names, key, {name: out_name})
    return named.select(*by, key, out_name, "order_amount", *(["order_ct"] if with_order_ct else []))


def trademark_top_n(product_stats: DataFrame, n: int = 10, date: str | None = None) -> DataFrame:
    return amount_top_n(product_stats, ["tm_id", "tm_name"], n, date)


def category3_top_n(product_stats: DataFrame, n: int = 10, date: str | None = None) -> DataFrame:
    return amount_top_n(product_stats, ["category3_id", "category3_name"], n, date)


def spu_top_n(product_stats: DataFrame, n: int = 10, date: str | None = None) -> DataFrame:
    return amount_top_n(product_stats, ["spu_id", "spu_name"], n, date, with_order_ct=True)


def province_amounts(province_stats: DataFrame, date: str | None = None) -> DataFrame:
    """AG-9: amount per province of the day."""
    s, by = _day(province_stats, date)
    return s.groupBy(*by, "province_id", "province_name") \
        .agg(F.sum("order_amount").cast(SUM_MONEY).alias("order_amount"))


def province_amounts_of(province_stats: DataFrame, provinces: DataFrame, date: str | None = None) -> DataFrame:
    """AG-9 from statistics by ``province_id`` that have no names yet: names are looked up for the sums."""
    s, by = _day(province_stats, date)
    g = s.groupBy(*by, "province_id").agg(F.sum("order_amount").cast(SUM_MONEY).alias("order_amount"))
    return enrich_province(g, provinces).select(*by, "province_id", "province_name", "order_amount")


def visitors_by_flag(visitor_stats: DataFrame, date: str | None = None) -> DataFrame:
    """AG-10: visitor sums per new/old flag."""
    s, by = _day(visitor_stats, date)
    return s.groupBy(*by, "is_new").agg(*[F.sum(c).cast("long").alias(c)
                                          for c in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")])


def visitors_by_hour(visitor_stats: DataFrame, date: str | None = None, zero_fill: bool = True) -> DataFrame:
    """AG-11 + AG-13 + SO-2: per hour of ``stt``: new_uv, uv, pv, uj; with
    ``zero_fill`` every hour 00..23 of each day appears (zeros when empty) and
    ``hr`` is the two-digit label."""
    s, by = _day(visitor_stats, date)
    hr = F.substring("stt", 12, 2).cast("int")
    g = s.groupBy(*by, hr.alias("hour")).agg(
        F.sum(F.when(F.col("is_new") == "1", F.col("uv_ct")).otherwise(0)).cast("long").alias("new_uv"),
        F.sum("uv_ct").cast("long").alias("uv_ct"), F.sum("pv_ct").cast("long").alias("pv_ct"),
        F.sum("uj_ct").cast("long").alias("uj_ct"))
    if zero_fill:
        if by:  # every day present, times 24 hours: a generator, not a join of tables
            hours = s.select("dt").distinct().select("dt", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
        else:
            hours = s.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
        g = hours.join(g, on=by + ["hour"], how="left").select(
            *by, "hour", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
                           for c in ("new_uv", "uv_ct", "pv_ct", "uj_ct")])
    out = g.select(*by, F.lpad(F.col("hour").cast("string"), 2, "0").alias("hr"),
                   "new_uv", "uv_ct", "pv_ct", "uj_ct")
    return out.orderBy(*by, "hr") if not by else out


FLAG_METRICS = ("uv_ct", "pv_ct", "uj_rate", "dur_per_sv", "pv_per_sv")


def visitor_flag_table(visitor_stats: DataFrame, date: str | None = None) -> DataFrame:
    """AG-14 + MET-1..3: one row per metric with ``new`` (is_new='1') and ``old``
    (any other flag) columns; a missing group counts as zeros."""
    s, by = _day(visitor_stats, date)
    flag = F.when(F.col("is_new") == "1", "new").otherwise("old")
    g = s.groupBy(*by, flag.alias("flag")).agg(*[F.sum(c).cast("long").alias(c)
                                                for c in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")])
    m = g.select(*by, "flag", F.col("uv_ct").cast(OUT_TYPE).alias("uv_ct"),
                 F.col("pv_ct").cast(OUT_TYPE).alias("pv_ct"), *visitor_ratios())
    long = m.unpivot([*by, "flag"], list(FLAG_METRICS), "metric", "value")
    wide = long.groupBy(*by, "metric").pivot("flag", ["new", "old"]).agg(F.first("value"))
    zero = F.lit(0).cast(OUT_TYPE)
    return wide.select(*by, "metric", F.coalesce("new", zero).alias("new"), F.coalesce("old", zero).alias("old"))


def keyword_score_top_n(keyword_stats: DataFrame, n: int = 20, date: str | None = None) -> DataFrame:
    """AG-12: ``sum(ct * weight(source))`` per keyword, ordered by the
    *unweighted* ``sum(ct)`` desc (keyword as tie-break), first ``n``."""
    s, by = _day(keyword_stats, date)
    g = s.groupBy(*by, "keyword").agg(
        F.sum(F.col("ct") * keyword_weight("source")).cast("long").alias("ct"),
        F.sum("ct").cast("long").alias("_raw"))
    return _top(g, by, [F.col("_raw").desc(), F.col("keyword").asc()], n).drop("_raw")
