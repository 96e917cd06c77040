"""DWS jobs as SQL text over topics (SRC-2, AG-3, AG-4).

A topic becomes a view with typed columns, an event time ``rt`` and a watermark
(``topics.json_table``); the job is one SELECT with ``window`` and, for words,
``LATERAL split_keyword``.  ``spark.sql`` on a streaming view is a streaming
DataFrame, so the text runs on tables and on streams alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from retailstream.functions.keywords import register_split_keyword
from retailstream.functions.timefmt import parse_ts
from retailstream.schemas import MONEY, PAGE, L, _struct
from retailstream.sources.topics import json_table

PAGE_TOPIC = StructType().add("common", _struct("mid")).add("page", PAGE).add("ts", L)
ORDER_WIDE_TOPIC = _struct("order_id", "province_id", "province_name", "province_area_code", "province_iso_code",
                           "province_3166_2_code", "total_amount", "create_time",
                           types={"order_id": L, "province_id": L, "total_amount": MONEY})

KEYWORD_JOB = """
SELECT w.word AS keyword, count(*) AS ct, '{source}' AS source,
       date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt, date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt
FROM (SELECT rt, page.item AS full_word FROM {view}
      WHERE page.item_type = 'keyword' AND page.item IS NOT NULL), LATERAL split_keyword(full_word) AS w(word)
GROUP BY window(rt, '{window}'), w.word
"""

PROVINCE_JOB = """
SELECT date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt, date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
       province_id, province_name, province_area_code, province_iso_code, province_3166_2_code,
       CAST(sum(total_amount) AS DECIMAL(38,2)) AS order_amount, {orders} AS order_count
FROM {view}
GROUP BY window(rt, '{window}'), province_id, province_name, province_area_code, province_iso_code, province_3166_2_code
"""


def keyword_job(spark: SparkSession, topic: DataFrame, view: str = "page_view", window: str = "10 seconds",
                delay: str = "2 seconds", source: str = "SEARCH") -> DataFrame:
    """AG-4 from a topic of page records (``value``): words of searches by window."""
    register_split_keyword(spark)
    json_table(topic, PAGE_TOPIC, F.timestamp_millis("ts"), delay if topic.isStreaming else None, view)
    return spark.sql(KEYWORD_JOB.format(view=view, window=window, source=source))


def province_job(spark: SparkSession, topic: DataFrame, view: str = "order_wide_view", window: str = "10 seconds",
                 delay: str = "2 seconds") -> DataFrame:
    """AG-3 from a topic of order-wide records: amounts and orders of provinces by window.

    Exact distinct counts need a state row for each order on a stream; the text counts
    them approximately there (2 % standard error) and exactly on tables.  The exact stream is
    ``jobs.province_stats_stream``.
    """
    at = parse_ts("create_time").cast("timestamp")
    json_table(topic, ORDER_WIDE_TOPIC, at, delay if topic.isStreaming else None, view)
    orders = "approx_count_distinct(order_id, 0.02)" if topic.isStreaming else "count(DISTINCT order_id)"
    return spark.sql(PROVINCE_JOB.format(view=view, window=window, orders=orders))

