"""Pattern rules on streams: ``operators.patterns`` with state per key.

Predicates are evaluated by Spark before the rows reach the state; a processor
gets times, order and flags only.  A key's rows wait until the watermark has passed
them, then each start is walked; rows older than the oldest open start are let go.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from retailstream.operators.patterns import Step, expand, flags

_STATE = "ts bigint, seq bigint, flags array<boolean>, open boolean"
_OUT = "ts bigint, seq bigint, outcome string, decided_at bigint, reached int, met array<struct<ts bigint, seq bigint>>"


def walk(rows: Sequence[tuple], at: int, strict: Sequence[bool], within_ms: int) -> tuple[str | None, int, list]:
    """Outcome (None: open), its time and the rows met, of the start ``rows[at]``, over
    ``rows`` (``ts, seq, flags, ...``) in order."""
    begin, n = rows[at], 1
    met = [begin[:2]]
    if n == len(strict):
        return "match", begin[0], met
    for r in rows[at + 1:]:
        if r[0] - begin[0] >= within_ms:
            return "timeout", begin[0] + within_ms, met
        if r[2][n]:
            met.append(r[:2])
            n += 1
            if n == len(strict):
                return "match", r[0], met
        elif strict[n]:
            return "broken", r[0], met
    return None, begin[0] + within_ms, met


class PatternOutcomes(StatefulProcessor):
    def __init__(self, strict: Sequence[bool], within_ms: int):
        self.strict = list(strict)
        self.within = within_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", _STATE)

    def _advance(self, key, wm: int, new: Sequence[tuple] = ()) -> Iterator[Row]:
        held = [(r[0], r[1], r[2], r[3]) for r in self.rows.get()] if self.rows.exists() else []
        rows = sorted([*held, *new], key=lambda r: r[:2])
        final = [r for r in rows if r[0] <= wm]
        kept, first = [], None
        for i, r in enumerate(final):
            if r[3]:
                outcome, decided, met = walk(final, i, self.strict, self.within)
                if outcome is None and wm >= r[0] + self.within:
                    outcome = "timeout"
                if outcome is None:
                    first = r[0] if first is None else first
                else:
                    r = (*r[:3], False)
                    if outcome != "broken":
                        yield Row(_key=key[0], ts=r[0], seq=r[1], outcome=outcome, decided_at=decided,
                                  reached=len(met), met=[Row(ts=t, seq=s) for t, s in met])
            if first is not None:
                kept.append(r)
        rest = rows[len(final):]
        if first is not None:
            self.handle.registerTimer(first + self.within)
        if rest:
            self.handle.registerTimer(rest[0][0])
        if kept or rest:
            self.rows.put([tuple(r) for r in [*kept, *rest]])
        else:
            self.rows.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs()
        # a row at or below the watermark is late and lost, as in ST-3
        new = [(r["ts"], r["seq"], list(r["flags"]), r["flags"][0]) for r in rows if r["ts"] > wm]
        yield from self._advance(key, wm, new)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(key, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def outcomes_stream(rows: DataFrame, steps: Sequence[Step], key: Column, within_ms: int, ts: str = "ts",
                    seq: str = "seq", delay: str = "1 second") -> DataFrame:
    """``key, ts, seq, outcome, decided_at, reached, met`` of the starts, as
    ``operators.patterns.outcomes`` has them (without broken ones), each when it is certain."""
    steps = expand(steps)
    x = rows.select(key.cast("string").alias("_key"), F.col(ts).cast("long").alias("ts"), F.col(seq).cast("long").alias("seq"),
                    F.array(*flags(steps)).alias("flags")).where("_key IS NOT NULL AND ts IS NOT NULL")
    x = x.withColumn("rt", F.timestamp_millis("ts")).withWatermark("rt", delay)
    if not any(s.next for s in steps):
        # named with the event time, the filter stays behind the watermark, which all rows move
        x = x.where(F.when(F.col("rt").isNotNull(), F.exists("flags", lambda f: f)))
    out = x.groupBy("_key").transformWithState(
        PatternOutcomes([s.next for s in steps], within_ms), f"_key string, {_OUT}", "Append", "EventTime")
    return out.withColumnRenamed("_key", "key")
