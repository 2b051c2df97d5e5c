"""Column expressions shared by the operators.

Everything here returns a native Spark ``Column`` so it stays inside
whole-stage codegen: no Python UDF anywhere in the library.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0
MICROS_PER_HOUR = 3_600_000_000.0
EARTH_RADIUS_KM = 6371.0


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    """Text that is empty or only blanks becomes NULL (T1)."""
    c = _c(c)
    return F.when(F.trim(c) == "", F.lit(None)).otherwise(c)


def text_to_timestamp(c: str | Column, strict: bool = True) -> Column:
    """VARCHAR -> TIMESTAMP_NTZ after blank removal.

    ``strict`` raises on malformed text (ANSI cast), otherwise malformed
    text becomes NULL (``try_cast``).
    """
    cleaned = blank_to_null(c)
    if strict:
        return cleaned.cast("timestamp_ntz")
    return cleaned.try_cast("timestamp_ntz")


def micros_between(end: str | Column, start: str | Column) -> Column:
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def floor_days(end: str | Column, start: str | Column) -> Column:
    """Whole days from ``start`` to ``end``, floored (-23 h -> -1) (T10)."""
    return F.floor(micros_between(end, start) / F.lit(MICROS_PER_DAY))


def hours_between(end: str | Column, start: str | Column) -> Column:
    """Fractional hours from ``start`` to ``end``."""
    return micros_between(end, start) / F.lit(MICROS_PER_HOUR)


def add_fractional_days(ts: str | Column, days: str | Column) -> Column:
    """``ts + days`` for fractional days, at microsecond precision (T12)."""
    micros = F.round(_c(days) * F.lit(MICROS_PER_DAY)).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, _c(ts))


def add_days(ts: str | Column, whole: Column, fraction: Column) -> Column:
    """``add_fractional_days`` of ``whole`` (without a fraction, so nothing is
    rounded) or, where that is NULL, of ``fraction``."""
    micros = F.when(whole.isNotNull(), (whole * F.lit(MICROS_PER_DAY)).cast("bigint")) \
              .otherwise(F.round(fraction * F.lit(MICROS_PER_DAY)).cast("bigint"))
    return F.timestamp_add("MICROSECOND", micros, _c(ts))


def add_whole_days(ts: str | Column, days: int) -> Column:
    return F.timestamp_add("DAY", F.lit(days), _c(ts))


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """Great-circle distance in km; nulls propagate (T17)."""
    la1, lo1, la2, lo2 = (F.radians(_c(x)) for x in (lat1, lng1, lat2, lng2))
    a = (F.pow(F.sin((la2 - la1) / 2), 2)
         + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2))
    a = F.least(F.lit(1.0), a)
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def hash_fold(key: str | Column, k: int, salt: str = "42") -> Column:
    """Deterministic fold id in [0, k) from the key (T22).

    First 32 bits of md5(key || ':' || salt) as an unsigned integer, mod k.
    Independent of partitioning, so it survives recomputation after an
    executor loss and is reproducible in any SQL engine with md5.
    """
    digest = F.md5(F.concat(_c(key).cast("string"), F.lit(f":{salt}")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(k)).cast("int")
