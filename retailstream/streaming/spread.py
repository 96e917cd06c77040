"""ST-1, ST-2 and ST-3 on streams whose hot visitors are spread over tasks.

A keyed processor reads all of a visitor's rows of a micro-batch in one Python
task.  Here a micro-batch is an ordinary table (``foreachBatch``): its rows find
their neighbours by the bucketed helper of the batch operators, so a visitor is
spread over as many tasks as there are buckets, and only what the visitor's *first*
row needs comes from state, one row a visitor:

* ST-1: visitors seen as new, ST-2: the date of a visitor's last visit.  Both are
  key tables of ``sources.dimstore``: a batch reads the buckets of its own visitors
  and adds a run of those that changed.
* ST-3: the rows not yet decided (later than the watermark, and entries whose time is
  still running), and the watermark.  Each batch writes them whole to one of two
  slots and reads the other.

State belongs to a query (its id is part of the path), so a new checkpoint starts
anew.  A batch writes its rows first and its state after them: a replay finds the state
of the batch before, and rows that are already listed are not written again.
Results are those of ``streaming.processors``.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from retailstream.functions.timefmt import DAY_FORMAT, ms_to_string
from retailstream.operators import visits
from retailstream.operators.sequence import with_neighbor
from retailstream.sources import dimstore, sinks
from retailstream.streaming.jobs import _start
from retailstream.streaming.processors import FLAT_FIELDS, FLAT_PAGE, placed

BUCKET_ROWS = 100_000   # of a micro-batch, by ``seq``
META = "batch_id long, watermark long"


class VisitorTable:
    """One value for each visitor, with the time it was written (for expiry)."""

    def __init__(self, where: str, run: str, ttl_ms: int | None = None):
        self.path, self.run, self.ttl_ms = f"{where}/query={run}", run, ttl_ms

    def open(self, spark, start: DataFrame | None, now: int) -> None:
        """Make the table if there is none, with the rows ``start`` (``mid, value``)."""
        dimstore.create(spark, self.path, ["value", "at"], "mid")
        if start is not None:
            self.add(start.where("mid IS NOT NULL"), -1, now)

    def has(self, spark, batch_id: int) -> bool:
        return dimstore.has(spark, self.path, f"{self.run}:{batch_id}")

    def of(self, mids: DataFrame, now: int) -> DataFrame:
        """``mid, known`` of those of ``mids`` that have a value which has not expired."""
        found = dimstore.lookup(mids.sparkSession, self.path, mids.select("mid").distinct())
        if self.ttl_ms is not None:
            found = found.where(F.col("at").cast("long") + self.ttl_ms > now)
        return found.select("mid", F.col("value").alias("known"))

    def add(self, rows: DataFrame, batch_id: int, now: int) -> None:
        """The values ``mid, value`` of a batch take the place of older ones."""
        changes = rows.select("mid", F.lit(batch_id + 1).cast("long").alias("seq"), F.lit("update").alias("type"), "value",
                              F.lit(now).alias("at"))
        sinks.upsert_dimension_table(rows.sparkSession, changes, self.path, "mid", f"{self.run}:{batch_id}")


def repair_new_visitor_batch(flat: DataFrame, table: VisitorTable, now: int) -> tuple[DataFrame, DataFrame]:
    """ST-1 on a micro-batch: (its rows, the visitors to remember).  Rows that claim no new visitor do not move."""
    rows = placed(flat)
    claims = rows.where("is_new = '1'")
    known = table.of(claims, now)
    fixed = visits.repair_new_visitor(claims, "mid", "is_new", "seq").join(known, "mid", "left")
    fixed = fixed.withColumn("is_new", F.when(F.col("known").isNotNull(), F.lit("0")).otherwise(F.col("is_new")))
    others = rows.where("is_new IS NULL OR is_new != '1'")
    new = claims.select("mid").distinct().join(known, "mid", "left_anti").select("mid", F.lit("1").alias("value"))
    return fixed.select(*flat.columns).unionByName(others), new


def daily_unique_visit_batch(flat: DataFrame, table: VisitorTable, now: int, zone: str = "UTC",
                             bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, DataFrame]:
    """ST-2 on a micro-batch: (the visits kept, the dates to remember)."""
    entries = placed(flat).where("last_page_id IS NULL").withColumn("_dt", ms_to_string("ts", zone, DAY_FORMAT))
    known = table.of(entries, now)
    near = with_neighbor(entries, ["mid"], ["seq"], F.call_function("div", F.col("seq"), F.lit(bucket_rows)),
                         ["_dt"], "prev", "_prev").join(known, "mid", "left")
    before = F.coalesce("_prev_dt", "known")   # no entry before in this batch: the one remembered
    kept = near.where(before.isNull() | (before != F.col("_dt")))
    last = kept.groupBy("mid").agg(F.max_by("_dt", "seq").alias("value"))
    return kept.select(*flat.columns), last


def bounce_detect_batch(rows: DataFrame, watermark: int, within_ms: int, bucket_ms: int) -> DataFrame:
    """ST-3 on the open and the new rows together: the rows, with ``_state``.

    ``bounce``: an entry that is emitted now; ``open``: to be looked at again, a row
    later than ``watermark`` or an entry that neither a row up to it nor its time
    has decided; null: done with.
    """
    near = with_neighbor(rows, ["mid"], ["ts", "seq"], F.floor(F.col("ts") / bucket_ms), ["ts", "last_page_id"],
                         "next", "_next_")
    ts, after = F.col("ts"), F.col("_next_ts")
    followed = F.coalesce(after <= watermark, F.lit(False))
    stays = F.col("_next_last_page_id").isNotNull() & (after - ts < within_ms)
    state = (F.when(ts > watermark, "open").when(F.col("last_page_id").isNotNull(), None)
             .when(followed, F.when(~stays, "bounce"))
             .when(F.lit(watermark) >= ts + within_ms, "bounce").otherwise("open"))
    return near.withColumn("_state", state).drop("_next_ts", "_next_last_page_id")


def _on_visitors(flat: DataFrame, name: str, out: str, state: str, checkpoint: str, ttl_ms: int | None,
                 start: DataFrame | None, rule: Callable[[DataFrame, VisitorTable, int], tuple[DataFrame, DataFrame]],
                 trigger: dict | None) -> StreamingQuery:
    def batch(df: DataFrame, bid: int, run: str) -> None:
        spark, now = df.sparkSession, int(time.time() * 1000)
        table = VisitorTable(state, run, ttl_ms)
        if bid == 0:
            table.open(spark, start, now)
        if table.has(spark, bid):   # its rows were written before
            return
        df = df.persist()
        kept, values = rule(df, table, now)
        sinks.write_topic(kept, out, batch_id=bid, run=run)
        table.add(values, bid, now)
        df.unpersist()
    return _start(flat, name, checkpoint, batch, trigger)


def start_new_visitor_repair(flat: DataFrame, out: str, state: str, checkpoint: str, ttl_ms: int | None = None,
                             seen: DataFrame | None = None, trigger: dict | None = None) -> StreamingQuery:
    """ST-1 from a stream of flat rows to the topic ``out``.  ``state``: shared folder for the visitors seen;
    ``seen`` (``visits.new_visitors_seen``): those known when the query starts for the first time."""
    start = None if seen is None else seen.select("mid", F.lit("1").alias("value"))
    return _on_visitors(flat, "dwd_new_visitor", out, state, checkpoint, ttl_ms, start, repair_new_visitor_batch, trigger)


def start_unique_visit(flat: DataFrame, out: str, state: str, checkpoint: str, ttl_ms: int | None = 86_400_000,
                       zone: str = "UTC", last_dates: DataFrame | None = None, bucket_rows: int = BUCKET_ROWS,
                       trigger: dict | None = None) -> StreamingQuery:
    """ST-2, as ``jobs.start_unique_visit``; ``last_dates`` (``visits.last_visit_dates``) as for its processor.
    Expiry is looked up when a batch comes, so no clock keeps the query busy."""
    start = None if last_dates is None else last_dates.select("mid", F.col("dt").alias("value"))
    return _on_visitors(flat, "dwm_unique_visit", out, state, checkpoint, ttl_ms, start,
                        lambda d, t, now: daily_unique_visit_batch(d, t, now, zone, bucket_rows), trigger)


def start_user_jump(flat: DataFrame, out: str, state: str, checkpoint: str, within_ms: int = 10_000,
                    delay_ms: int = 1_000, bucket_ms: int | None = None, trigger: dict | None = None) -> StreamingQuery:
    """ST-3, as ``jobs.start_user_jump``: rows up to the watermark (the largest time so far, less ``delay_ms``)
    are late when they come, and open rows are decided when it passes them.  ``bucket_ms`` (default: ``within_ms``):
    stretch of a visitor's rows that one task reads."""
    entry = F.col("last_page_id").isNull()
    slim = {c: F.when(entry, F.col(c)) for c in ("item", "item_type", "displays", "start", "page_id")}

    def batch(df: DataFrame, bid: int, run: str) -> None:
        spark, where = df.sparkSession, f"{state}/query={run}"
        new, before, watermark = placed(df).select(*FLAT_FIELDS), None, 0
        if bid:
            slot = f"{where}/slot={(bid - 1) % 2}"
            meta = spark.read.schema(META).parquet(f"{slot}/meta").first()
            if meta is None or meta["batch_id"] != bid - 1:
                raise RuntimeError(f"{slot} does not hold the state after batch {bid - 1}")
            before, watermark = spark.read.schema(FLAT_PAGE).parquet(f"{slot}/open"), meta["watermark"]
        new = new.persist()
        latest = new.agg(F.max("ts")).first()[0]
        rows = new.where(F.col("ts") > watermark).withColumns(slim)
        rows = rows if before is None else rows.unionByName(before)
        if latest is not None:
            watermark = max(watermark, latest - delay_ms)
        decided = bounce_detect_batch(rows, watermark, within_ms, bucket_ms or within_ms).persist()
        sinks.write_topic(decided.where("_state = 'bounce'").drop("_state"), out, batch_id=bid, run=run)
        slot = f"{where}/slot={bid % 2}"
        decided.where("_state = 'open'").select(*FLAT_FIELDS).write.mode("overwrite").parquet(f"{slot}/open")
        (spark.createDataFrame([(bid, watermark)], META).coalesce(1)
         .write.mode("overwrite").parquet(f"{slot}/meta"))   # last: it says that the slot is whole
        decided.unpersist()
        new.unpersist()
    return _start(flat, "dwm_user_jump", checkpoint, batch, trigger)
