"""Pattern rules over a key's rows: ST-3 and ST-4 as parameters.

A pattern is a list of steps.  It starts at every row that meets the first step;
each further step takes the first later row that meets it (``follows``), or must
be met by the very next row (``next``).  A start ends in one of

* ``match``: all steps were met within ``within_ms`` of the start;
* ``timeout``: that time passed with steps open;
* ``broken``: the row after a step did not meet the ``next`` step behind it.

Everything that decides a start lies within ``within_ms`` of it.  So rows are cut
into time buckets of at least that length, each row is seen in its own bucket and
as look-ahead by the one before, and windows run per (key, bucket): a hot key is
spread over its buckets, and there is one shuffle whatever the number of steps.
The stream form is ``retailstream.streaming.patterns``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Step:
    where: Column        # the rows that meet the step; null counts as not met
    next: bool = False   # must be the very next row; else rows between are passed over
    times: int = 1       # so many rows one after the other, by the same rule


def expand(steps: Sequence[Step]) -> list[Step]:
    """Steps of ``times`` 1."""
    if not steps or any(s.times < 1 for s in steps):
        raise ValueError("a pattern needs steps, each at least once")
    return [replace(s, times=1) for s in steps for _ in range(s.times)]


def flags(steps: Sequence[Step]) -> list[Column]:
    return [F.coalesce(s.where, F.lit(False)) for s in steps]


def outcomes(rows: DataFrame, steps: Sequence[Step], key: Column, within_ms: int, ts: str = "ts", seq: str = "seq",
             bucket_ms: int | None = None, broken: bool = False) -> DataFrame:
    """The rows that start the pattern, with ``outcome``, ``decided_at`` (ms: of the last
    step's row, of the row that broke it, or the end of the time), ``reached`` (steps met)
    and ``met`` (``ts, seq`` of the rows that met them, the start first).

    ``(ts, seq)`` orders a key's rows and should be unique in it; equal ones are in any
    order.  Rows without key or ``ts`` take no part.  ``broken`` starts are left out
    unless asked for.
    """
    steps = expand(steps)
    bucket_ms = max(bucket_ms or 0, within_ms)
    if bucket_ms < 1:
        raise ValueError("within_ms must be positive")
    strict = [s.next for s in steps]
    names = [f"_p{k}" for k in range(len(steps))]
    wide = F.when(F.col("_own") & F.col("_p0"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
    seen = rows.select("*", key.alias("_key"), F.col(ts).alias("_ts"), F.col(seq).alias("_seq"),
                       *[p.alias(n) for p, n in zip(flags(steps), names, strict=True)])
    seen = seen.where("_key IS NOT NULL AND _ts IS NOT NULL")
    if not any(strict):   # rows that meet no step break nothing either
        seen = seen.where(" OR ".join(names))
    home = F.expr(f"floor(_ts / {bucket_ms}D)").cast("long")
    seen = (seen.withColumn("_at", F.explode(F.array(F.lit(0), F.lit(-1)).cast("array<bigint>")))
            .withColumns({"_b": home + F.col("_at"), "_own": F.col("_at") == 0})
            .select("_key", "_b", "_own", "_ts", "_seq", *names, wide.alias("_row")))

    # later rows first, so that frames grow as they are read
    w = Window.partitionBy("_key", "_b").orderBy(F.desc("_ts"), F.desc("_seq"))
    later = w.rowsBetween(Window.unboundedPreceding, -1)
    seen = seen.withColumn("_this", F.array(F.struct(F.col("_ts").alias("ts"), F.col("_seq").alias("seq"),
                                                     F.lag("_ts").over(w).alias("next_ts"))))
    seen = seen.withColumn("_chain", F.when(F.col(names[-1]), F.col("_this")))
    for k in range(len(steps) - 2, -1, -1):
        then = F.lag("_chain").over(w) if strict[k + 1] else F.last("_chain", ignorenulls=True).over(later)
        seen = seen.withColumn("_then", then).withColumn(
            "_chain", F.when(F.col(names[k]), F.when(F.col("_then").isNull(), F.col("_this"))
                             .otherwise(F.concat("_this", "_then"))))

    start = seen.where("_row IS NOT NULL").withColumn(
        "_met", F.filter("_chain", lambda e: e["ts"] - F.col("_ts") < within_ms))
    start = start.withColumn("reached", F.size("_met")).withColumn("_last", F.element_at("_met", -1))
    ahead = F.array(*[F.lit(s) for s in strict[1:]], F.lit(False))[F.col("reached") - 1]   # is the open step a `next`
    cut = ahead & F.coalesce(F.col("_last.next_ts") - F.col("_ts") < within_ms, F.lit(False))
    outcome = (F.when(F.col("reached") == len(steps), "match").when(cut, "broken").otherwise("timeout"))
    start = start.withColumn("outcome", outcome).withColumn(
        "decided_at", F.when(F.col("outcome") == "match", F.col("_last.ts"))
        .when(F.col("outcome") == "broken", F.col("_last.next_ts")).otherwise(F.col("_ts") + within_ms))
    if not broken:
        start = start.where("outcome != 'broken'")
    return start.select("_row.*", "outcome", "decided_at", "reached",
                        F.transform("_met", lambda e: F.struct(e["ts"].alias("ts"), e["seq"].alias("seq"))).alias("met"))
