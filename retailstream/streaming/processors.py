"""Streaming forms of the per-visitor rules ST-1, ST-2 and ST-3.

Window functions are refused on streams, so these are ``transformWithState``
processors keyed by visitor (``groupBy("mid")``).  State is per visitor and
small (a flag, a date, or the few rows not yet passed by the watermark), lives
in the state store (RocksDB) and is checkpointed with the query, so a lost
executor resumes from the last committed micro-batch.

Rows are *flat* page rows (``FLAT_PAGE``); ``flatten_page_log`` /
``nest_page_log`` convert from / to the nested page-log layout.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

S, L = StringType(), LongType()
FLAT_FIELDS = ("seq", "ts", "mid", "vc", "ch", "ar", "is_new", "page_id", "last_page_id", "item", "item_type",
               "during_time", "displays", "start")
FLAT_PAGE = StructType([StructField(n, L if n in ("seq", "ts", "during_time") else S) for n in FLAT_FIELDS])


def flatten_page_log(log: DataFrame, whole_common: bool = False) -> DataFrame:
    """Nested page log -> ``FLAT_PAGE`` (displays kept as JSON text).  ``whole_common`` adds all of
    ``common`` as JSON text, with the fields that the flat rows leave out."""
    more = [F.to_json("common").alias("common")] if whole_common else []
    return log.select("seq", "ts", *[F.col(f"common.{c}").alias(c) for c in ("mid", "vc", "ch", "ar", "is_new")],
                      *[F.col(f"page.{c}").alias(c) for c in ("page_id", "last_page_id", "item", "item_type",
                                                                "during_time")],
                      F.to_json("displays").alias("displays"),
                      (F.coalesce(*[c for n, c in (("start_text", F.col("start_text")), ("start", F.to_json("start")))
                                    if n in log.columns], F.lit(None).cast("string"))).alias("start"), *more)


def nest_page_log(flat: DataFrame, displays_type: DataType) -> DataFrame:
    """``FLAT_PAGE`` -> nested page log (inverse of ``flatten_page_log``)."""
    return flat.select(
        F.struct(*[F.col(c) for c in ("mid", "is_new", "vc", "ch", "ar")]).alias("common"),
        F.struct(*[F.col(c) for c in ("page_id", "last_page_id", "item", "item_type", "during_time")]).alias("page"),
        F.from_json("displays", displays_type).alias("displays"), "ts", "seq")


def _key(r: Row) -> tuple:
    return (r["ts"], r["seq"])


def _replace(r: Row, fields: tuple[str, ...] = FLAT_FIELDS, **kw) -> Row:
    d = r.asDict()
    d.update(kw)
    return Row(**{n: d[n] for n in fields})


def _day(ms: int, zone: ZoneInfo) -> str:
    at = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc) + _dt.timedelta(milliseconds=ms)
    return at.astimezone(zone).strftime("%Y-%m-%d")


def placed(flat: DataFrame) -> DataFrame:
    """Rows that a keyed processor can place: with a visitor and a time.  The
    others must not reach it (they would fail the query on every restart);
    ``start_log_split`` writes them to its reject output (D11)."""
    return flat.where(F.col("mid").isNotNull() & F.col("ts").isNotNull())


class NewVisitorRepair(StatefulProcessor):
    """ST-1: the first ``is_new='1'`` row of a visitor (arrival = ``seq`` order)
    keeps '1'; every later one becomes '0'.  Optional TTL (the reference keeps
    this state forever)."""

    def __init__(self, ttl_ms: int | None = None, fields: tuple[str, ...] = FLAT_FIELDS):
        self.ttl_ms = ttl_ms
        self.fields = fields

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen_new", "seen boolean", self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """A visitor that a batch run has seen as new before the stream starts."""
        self.seen.update((True,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen = self.seen.exists()
        for r in sorted(rows, key=lambda x: x["seq"]):
            if r["is_new"] == "1":
                if seen:
                    r = _replace(r, self.fields, is_new="0")
                else:
                    seen = True
                    self.seen.update((True,))
            yield _replace(r, self.fields)

    def close(self) -> None:
        pass


class DailyUniqueVisit(StatefulProcessor):
    """ST-2: keep an entry row (no ``last_page_id``) when the remembered date is
    unset or differs; remember its date.  The date expires 24 h (processing
    time) after it was written, as in the reference."""

    def __init__(self, ttl_ms: int | None = 86_400_000, zone: str = "UTC"):
        self.ttl_ms = ttl_ms
        self.zone = zone

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_visit_date", "dt string", self.ttl_ms)
        self.days = ZoneInfo(self.zone)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """The date of the visitor's last visit before the stream starts."""
        self.last.update((initialState["dt"],))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else None
        for r in sorted(rows, key=lambda x: x["seq"]):
            if r["last_page_id"] is not None:
                continue
            d = _day(r["ts"], self.days)
            if last is None or last != d:
                last = d
                self.last.update((d,))
                yield _replace(r)

    def close(self) -> None:
        pass


class BounceDetect(StatefulProcessor):
    """ST-3 in event time: an entry ``s`` is emitted unless the visitor's next
    row ``n`` (order ``ts, seq``) is a non-entry with ``n.ts - s.ts < within``.

    Rows are buffered until the watermark passes them (then their order is
    final: anything older arriving later is late and dropped, like the
    reference).  The pending entry is emitted when its successor decides it,
    or by an event-time timer at ``s.ts + within`` (the timeout)."""

    def __init__(self, within_ms: int = 10_000):
        self.within = within_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buffer", FLAT_PAGE)
        self.pend = handle.getValueState("pending_entry", FLAT_PAGE)
        self.done = handle.getValueState("last_final", "ts bigint, seq bigint")

    def _advance(self, wm: int, new_rows=()) -> Iterator[Row]:
        done = tuple(self.done.get()) if self.done.exists() else None
        rows = [Row(**dict(zip(FLAT_FIELDS, r))) for r in self.buf.get()] if self.buf.exists() else []
        rows += [_replace(r) for r in new_rows if done is None or _key(r) > done]  # late rows dropped
        rows.sort(key=_key)
        final = [r for r in rows if r["ts"] <= wm]
        rest = [r for r in rows if r["ts"] > wm]
        pend = Row(**dict(zip(FLAT_FIELDS, self.pend.get()))) if self.pend.exists() else None
        for r in final:
            if pend is not None:
                stays = r["last_page_id"] is not None and r["ts"] - pend["ts"] < self.within
                if not stays:
                    yield pend
                pend = None
            if r["last_page_id"] is None:
                pend = r
        if final:
            self.done.update((final[-1]["ts"], final[-1]["seq"]))
        if pend is not None and wm >= pend["ts"] + self.within:
            yield pend  # timed out: no successor can be within `within` any more
            pend = None
        if pend is not None:
            self.pend.update(tuple(pend[n] for n in FLAT_FIELDS))
            self.handle.registerTimer(pend["ts"] + self.within)
        else:
            self.pend.clear()
        self.buf.clear()
        if rest:
            self.buf.put([tuple(r[n] for n in FLAT_FIELDS) for r in rest])
            self.handle.registerTimer(rest[0]["ts"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs()
        # a row at or below the watermark on arrival is late and lost, as in the reference
        yield from self._advance(wm, [r for r in rows if r["ts"] > wm])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def _started(state: DataFrame | None):
    """A batch snapshot, one row for each visitor, as the state that a stream starts with."""
    return None if state is None else state.where(F.col("mid").isNotNull()).groupBy("mid")


def repair_new_visitor_stream(flat: DataFrame, ttl_ms: int | None = None, seen: DataFrame | None = None) -> DataFrame:
    """Only ``is_new='1'`` rows read or write the state, so only they are
    shuffled to the per-visitor processor; every other row passes straight
    through (a hot visitor's ordinary traffic never reaches the keyed task).
    Columns beyond ``FLAT_PAGE`` are kept.  ``seen`` (``visits.new_visitors_seen``):
    visitors (``mid``) known as new from before, for the first start of a query."""
    flat = placed(flat)
    cand = F.col("is_new") == "1"
    fields = tuple(dict.fromkeys([*FLAT_FIELDS, *flat.columns]))
    schema = StructType([*FLAT_PAGE, *[flat.schema[c] for c in fields[len(FLAT_FIELDS):]]])
    fixed = flat.where(cand).groupBy("mid").transformWithState(
        NewVisitorRepair(ttl_ms, fields), schema, "Append", "None", initialState=_started(seen))
    return fixed.unionByName(flat.where(~cand | F.col("is_new").isNull()).select(*fields))


def daily_unique_visit_stream(flat: DataFrame, ttl_ms: int | None = 86_400_000, zone: str = "UTC",
                              last_dates: DataFrame | None = None) -> DataFrame:
    """With a TTL (the default, 24 h as in the reference) state expiry needs
    processing-time mode, in which the query keeps running no-data micro-batches
    to evaluate expiry; ``ttl_ms=None`` keeps dates forever and needs no clock.
    ``last_dates`` (``visits.last_visit_dates``): ``mid, dt`` from before, for the
    first start of a query."""
    mode = "None" if ttl_ms is None else "ProcessingTime"
    entries = placed(flat).where(F.col("last_page_id").isNull())  # non-entry rows never emit nor touch state
    return entries.groupBy("mid").transformWithState(DailyUniqueVisit(ttl_ms, zone), FLAT_PAGE, "Append", mode,
                                                     initialState=_started(last_dates))


class Changelog(StatefulProcessor):
    """CDC-2: the changes of one row's key as retractions, see ``changelog_stream``."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.now = handle.getValueState("current", "seq bigint, image map<string,string>")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """The row as a snapshot has it."""
        self.now.update((initialState["seq"], dict(initialState["data"])))   # a map comes as pairs

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        at, image = tuple(self.now.get()) if self.now.exists() else (None, None)
        changed = False
        for r in sorted(rows, key=lambda x: x["seq"]):
            if at is not None and r["seq"] <= at:
                continue   # older than what is known: a late or repeated change
            new = None if r["type"] == "delete" else dict(r["data"])
            out = [] if new == image else [
                (kind, value) for kind, value in (("-D" if new is None else "-U", image), ("+I" if image is None else "+U", new))
                if value is not None]
            for kind, value in out:
                yield Row(tableName=key[0], pk=key[1], seq=r["seq"], kind=kind, data=value)
            at, image, changed = r["seq"], new, True
        if changed:
            self.now.update((at, image))

    def close(self) -> None:
        pass


CHANGELOG = "tableName string, pk string, seq bigint, kind string, data map<string,string>"


def changelog_stream(changes: DataFrame, pk: str = "id", snapshot: DataFrame | None = None) -> DataFrame:
    """CDC-2 on a stream of flattened changes: ``tableName, pk, seq, kind, data``.

    Each change of a row takes back its image (``-U``, or ``-D`` when it is deleted)
    and gives the new one (``+U``, or ``+I`` when there was none); a change to the
    same image gives nothing.  By ``seq``: a change that comes after a later one of
    its row is dropped.  ``snapshot`` (``tableName, pk, seq, data``, one row a key): the
    rows as they are when the query starts for the first time (SRC-4).  The batch
    form is ``cdc.changelog_retractions``.
    """
    from retailstream.operators.cdc import keyed_changes
    rows = keyed_changes(changes, pk).select("tableName", "pk", "seq", "type", "data")
    start = None if snapshot is None else snapshot.select("tableName", "pk", "seq", "data").groupBy("tableName", "pk")
    return rows.groupBy("tableName", "pk").transformWithState(Changelog(), CHANGELOG, "Append", "None",
                                                              initialState=start)


def bounce_detect_stream(flat: DataFrame, within_ms: int = 10_000, delay: str = "1 second") -> DataFrame:
    """``flat`` must carry ``ts`` (epoch ms); the watermark is on ``rt``.
    Non-entry rows only decide whether the entry before them bounced, so their
    payload is dropped before the shuffle and the state buffer."""
    entry = F.col("last_page_id").isNull()
    slim = {c: F.when(entry, F.col(c)) for c in ("item", "item_type", "displays", "start", "page_id")}
    x = placed(flat).withColumns(slim).withColumn("rt", F.timestamp_millis("ts")).withWatermark("rt", delay).drop("rt")
    return x.groupBy("mid").transformWithState(BounceDetect(within_ms), FLAT_PAGE, "Append", "EventTime")
