"""Derived visitor metrics (MET-1..3) with exact half-up decimal rounding.

The ratios are computed in integer arithmetic, so the result is the exactly
rounded quotient (no intermediate decimal scale, no double rounding):
``round_half_up(n / d, s) = floor((2 * n * 10^s + d) / (2 * d)) / 10^s`` for
``n >= 0, d > 0``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

OUT_TYPE = DecimalType(38, 2)


def _exact_units(n: Column, d: Column, scale: int) -> Column:
    # decimal(38,0) arithmetic keeps the division exact before flooring
    nd = n.cast(DecimalType(38, 0))
    dd = d.cast(DecimalType(38, 0))
    f = 10 ** scale
    num = nd * (2 * f) + dd
    den = dd * 2
    # (num - num % den) is a multiple of den, so the decimal quotient is exact
    return F.when(dd != 0, ((num - num % den) / den).cast(DecimalType(38, 0)))


def units_to_decimal(units: Column, scale: int) -> Column:
    """Integer count of 10^-scale units -> DECIMAL(38,2) (exact)."""
    return (units.cast(DecimalType(38, 0)) / F.lit(10 ** scale)).cast(OUT_TYPE)


def ratio_half_up(n, d, scale: int) -> Column:
    """round_half_up(n / d, scale) as DECIMAL(38,2); null when d = 0."""
    n = F.col(n) if isinstance(n, str) else n
    d = F.col(d) if isinstance(d, str) else d
    return units_to_decimal(_exact_units(n, d, scale), scale)


def uj_rate(uv, uj, sv) -> Column:
    """MET-1: bounce rate % = round(uj*100/sv, 2); 0 when uv = 0 or sv = 0 (D7)."""
    return F.when(F.col(uv) != 0, F.coalesce(ratio_half_up(F.col(uj) * 100, F.col(sv), 2),
                                              F.lit(0).cast(OUT_TYPE))).otherwise(F.lit(0).cast(OUT_TYPE))


def dur_per_sv(uv, dur, sv) -> Column:
    """MET-2: seconds per visit = round(round(dur/sv, 0)/1000, 1); 0 when uv = 0 or sv = 0."""
    whole_ms = _exact_units(F.col(dur), F.col(sv), 0)
    tenths = _exact_units(whole_ms, F.lit(1000), 1)
    return F.when(F.col(uv) != 0, F.coalesce(units_to_decimal(tenths, 1),
                                              F.lit(0).cast(OUT_TYPE))).otherwise(F.lit(0).cast(OUT_TYPE))


def pv_per_sv(uv, pv, sv) -> Column:
    """MET-3: pages per visit = round(pv/sv, 2); 0 when uv = 0 or sv = 0."""
    return F.when(F.col(uv) != 0, F.coalesce(ratio_half_up(F.col(pv), F.col(sv), 2),
                                              F.lit(0).cast(OUT_TYPE))).otherwise(F.lit(0).cast(OUT_TYPE))


def visitor_ratios(uv="uv_ct", pv="pv_ct", sv="sv_ct", uj="uj_ct", dur="dur_sum") -> list[Column]:
    return [uj_rate(uv, uj, sv).alias("uj_rate"),
            dur_per_sv(uv, dur, sv).alias("dur_per_sv"),
            pv_per_sv(uv, pv, sv).alias("pv_per_sv")]
