"""DWM visit jobs on the page log: new-visitor repair (ST-1), daily unique visit
(ST-2) and bounce detection (ST-3), in batch form.  Streaming forms are in
``retailstream.streaming.processors``.

Page-log rows: ``common{mid,is_new,vc,ch,ar}, page{page_id,last_page_id,...},
displays, ts (epoch ms), seq (arrival order)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailstream.functions.timefmt import DAY_FORMAT, ms_to_string
from retailstream.operators.sequence import with_neighbor

HOUR_MS = 3_600_000
DAY_MS = 86_400_000


def repair_new_visitor(log: DataFrame, mid: str = "common.mid", is_new: str = "common.is_new",
                       seq: str = "seq") -> DataFrame:
    """ST-1: per visitor, only the first ``is_new='1'`` record (arrival order) keeps
    '1'; later ones become '0'.  Other records are untouched and set no state.

    The first '1' per visitor is a partial aggregation (``min(seq)``), joined back
    on the visitor to the ``is_new='1'`` rows alone; the other rows are not
    shuffled.  AQE splits a hot visitor's join partition.
    """
    candidates = log.where(F.col(is_new) == "1")
    others = log.where(F.col(is_new).isNull() | (F.col(is_new) != "1"))
    first = candidates.groupBy(F.col(mid).alias("_mid")).agg(F.min(seq).alias("_first_new_seq"))
    j = candidates.join(first, F.col(mid) == F.col("_mid"), "left")
    fixed = F.when((F.col(is_new) == "1") & (F.col(seq) > F.col("_first_new_seq")), F.lit("0")) \
        .otherwise(F.col(is_new))
    out = j.withColumn("common", F.col("common").withField("is_new", fixed)) if is_new == "common.is_new" \
        else j.withColumn(is_new, fixed)
    return out.drop("_mid", "_first_new_seq").unionByName(others)


def daily_unique_visit(log: DataFrame, mid: str = "common.mid", seq: str = "seq",
                       bucket_rows: int = 10_000_000, zone: str = "UTC") -> DataFrame:
    """ST-2: keep an entry record (``page.last_page_id is null``) iff the visitor's
    remembered date is unset or differs from the record's date; the remembered
    date is then that date.

    Because the remembered date always equals the date of the visitor's previous
    entry record (a skipped record has the same date), the rule is exactly
    "date differs from the previous entry's date" in arrival (``seq``) order.
    The previous entry is found with the bucketed neighbour helper, buckets being
    ``seq div bucket_rows``.  Dates are those of ``zone``.  Rows without visitor or
    time are not visits (``stats.split_rejects`` gives them, D11).
    """
    entries = log.where(F.col("page.last_page_id").isNull() & F.col("ts").isNotNull()) \
        .withColumn("_mid", F.col(mid)) \
        .withColumn("_dt", ms_to_string("ts", zone, DAY_FORMAT))
    n = with_neighbor(entries, ["_mid"], [seq], F.call_function("div", F.col(seq), F.lit(bucket_rows)), ["_dt"], "prev", "_prev")
    return n.where(F.col("_prev_dt").isNull() | (F.col("_prev_dt") != F.col("_dt"))) \
        .drop("_mid", "_dt", "_prev_dt")


def bounce_detect(log: DataFrame, within_ms: int = 10_000, mid: str = "common.mid", seq: str = "seq",
                  bucket_ms: int = HOUR_MS) -> DataFrame:
    """ST-3: an entry record ``s`` is a bounce unless the visitor's next record
    ``n`` (event-time order ``ts, seq``) is a non-entry page with
    ``n.ts - s.ts < within_ms``.  Entries with no next record, or whose next is an
    entry / comes at or after ``within_ms``, are emitted (match or timeout).

    The next record is found with the bucketed neighbour helper
    (buckets = ``ts div bucket_ms``), so a very active visitor is spread over many
    tasks instead of one.
    """
    return bounce_outcomes(log, within_ms, mid, seq, bucket_ms).drop("outcome", "decided_at")


def bounce_outcomes(log: DataFrame, within_ms: int = 10_000, mid: str = "common.mid", seq: str = "seq",
                    bucket_ms: int = HOUR_MS) -> DataFrame:
    """ST-3 with its two outputs told apart: ``outcome`` is ``match`` where another
    entry follows within ``within_ms``, and ``timeout`` where that time passes without
    any record; ``decided_at`` is the time (ms) at which the outcome is certain: of the next
    entry, or the end of the time.  Rows as in ``bounce_detect``.
    """
    x = log.where(F.col("ts").isNotNull()).withColumn("_mid", F.col(mid)).withColumn("_lp", F.col("page.last_page_id"))
    n = with_neighbor(x, ["_mid"], ["ts", seq], F.call_function("div", F.col("ts"), F.lit(bucket_ms)),
                      ["ts", "_lp"], "next", "_next_")
    nts, nlp = F.col("_next_ts"), F.col("_next__lp")
    soon = F.coalesce(nts - F.col("ts") < within_ms, F.lit(False))
    matched = soon & nlp.isNull()
    return (n.where(F.col("_lp").isNull() & (matched | ~soon))
            .withColumns({"outcome": F.when(matched, "match").otherwise("timeout"),
                          "decided_at": F.when(matched, nts).otherwise(F.col("ts") + within_ms)})
            .drop("_mid", "_lp", "_next_ts", "_next__lp"))


def new_visitors_seen(log: DataFrame, mid: str = "common.mid", is_new: str = "common.is_new") -> DataFrame:
    """The state of ST-1 after ``log``: ``mid`` of every visitor with an ``is_new='1'`` record.  A stream that
    takes over starts from it (``processors.repair_new_visitor_stream``)."""
    return log.where((F.col(is_new) == "1") & F.col(mid).isNotNull() & F.col("ts").isNotNull()).select(
        F.col(mid).alias("mid")).distinct()


def last_visit_dates(log: DataFrame, mid: str = "common.mid", seq: str = "seq", zone: str = "UTC") -> DataFrame:
    """The state of ST-2 after ``log``: ``mid, dt``, the date of each visitor's last entry record."""
    entries = log.where(F.col("page.last_page_id").isNull() & F.col("ts").isNotNull() & F.col(mid).isNotNull())
    return entries.groupBy(F.col(mid).alias("mid")).agg(F.max_by(ms_to_string("ts", zone, DAY_FORMAT), seq).alias("dt"))
