"""Time helpers (FN-1..7, FN-10).

Batch jobs keep event time as ``TIMESTAMP_NTZ`` so results do not depend on the
session time zone; epoch milliseconds are computed against the NTZ epoch, which
is exact and zone-free.  Streaming jobs convert to ``TIMESTAMP`` because
watermarks refuse NTZ (see ``to_stream_time``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# Fixed formats of the reference's string timestamps.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"
MS_PER_DAY = 86_400_000
MS_PER_365_DAYS = 31_536_000_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(ts) -> Column:
    """Epoch milliseconds of a NTZ (or zoned) timestamp, truncated."""
    t = _c(ts).cast("timestamp_ntz")
    # date parts of a NTZ value carry no zone, unlike timestampdiff (which
    # converts through the session zone and so shifts across DST changes)
    return (F.unix_date(F.to_date(t)).cast("long") * MS_PER_DAY
            + F.hour(t).cast("long") * 3_600_000 + F.minute(t).cast("long") * 60_000
            + F.floor(F.date_part(F.lit("SECOND"), t) * 1000).cast("long"))


def from_epoch_ms(ms) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ (zone-free inverse of ``epoch_ms``)."""
    return F.timestamp_add("MILLISECOND", _c(ms), F.expr(_EPOCH_NTZ))


def seconds_trunc(ms) -> Column:
    """FN-1: epoch ms -> NTZ timestamp truncated to whole seconds."""
    return from_epoch_ms(_c(ms) - F.pmod(_c(ms), F.lit(1000)))


def ts_string(ts) -> Column:
    """FN-3/5: timestamp -> 'yyyy-MM-dd HH:mm:ss'."""
    return F.date_format(_c(ts), TS_FORMAT)


def day_string(ts) -> Column:
    """FN-6: timestamp -> 'yyyy-MM-dd'."""
    return F.date_format(_c(ts), DAY_FORMAT)


def parse_ts(s) -> Column:
    """FN-2: 'yyyy-MM-dd HH:mm:ss' -> TIMESTAMP_NTZ (null when malformed).

    A cast parses this ISO layout natively, several times faster than a
    pattern-driven ``to_timestamp``; ``try_cast`` keeps bad text null under ANSI.
    """
    return _c(s).try_cast("timestamp_ntz")


def window_bounds(window_col: str = "window", streaming: bool = False, zone: str = "UTC") -> list[Column]:
    """FN-3: window struct -> stt / edt strings, wall-clock time of ``zone``.

    Batch windows are zone-free UTC times; stream windows are instants, which Spark
    would print in the session's zone: both give the same text here.
    """
    def text(c: Column) -> Column:
        if streaming:
            return ts_string(F.convert_timezone(F.current_timezone(), F.lit(zone), c.cast("timestamp_ntz")))
        return ts_string(c if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), c))
    return [text(F.col(f"{window_col}.start")).alias("stt"), text(F.col(f"{window_col}.end")).alias("edt")]


def age_years(birthday, as_of) -> Column:
    """FN-7: whole 365-day years between a 'yyyy-MM-dd' birthday and ``as_of``.

    Truncating integer division, as in the reference's ``long`` arithmetic.
    """
    b = epoch_ms(F.to_timestamp_ntz(_c(birthday), F.lit(DAY_FORMAT)))
    a = epoch_ms(_c(as_of))
    return int_div(a - b, F.lit(MS_PER_365_DAYS)).cast("int")


def int_div(num: Column, den: Column) -> Column:
    """Integer division truncating toward zero (Java ``long /``), exact."""
    return F.call_function("div", num, den)


def to_stream_time(ms) -> Column:
    """Epoch ms -> TIMESTAMP usable by ``withWatermark``."""
    return F.timestamp_millis(_c(ms))


def ms_to_string(ms, zone: str | None = None, fmt: str = TS_FORMAT) -> Column:
    """FN-5: epoch ms -> wall-clock text in ``zone`` (default: the session zone)."""
    z = F.lit(zone) if zone is not None else F.current_timezone()
    return F.date_format(F.convert_timezone(F.lit("UTC"), z, from_epoch_ms(ms)), fmt)


def string_to_ms(s, zone: str | None = None) -> Column:
    """FN-5: 'yyyy-MM-dd HH:mm:ss' read as wall-clock time in ``zone`` (the
    reference reads it at UTC+8) -> epoch ms; default: the session zone."""
    z = F.lit(zone) if zone is not None else F.current_timezone()
    return epoch_ms(F.convert_timezone(z, F.lit("UTC"), parse_ts(s)))
