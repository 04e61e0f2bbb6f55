"""Exact rounding of ratios of integers.

PostgreSQL averages and divides integers as exact numerics and rounds half
away from zero.  Spark's decimal average rounds its intermediate result, so a
value such as 25.49499.. can be rounded twice.  These helpers compute the
rounded value with integer arithmetic only (SQL ``div``) and return a double,
so the result is exact and engine-independent.  The quotient is taken first and
only the remainder is scaled, in decimals wide enough for any longs, so sums
of any size that fit a long do not overflow.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def idiv(a: Column, b: Column) -> Column:
    """Integral division of longs (SQL ``a div b``), null when b = 0."""
    return F.call_function("div", _col(a).cast("long"), _col(b).cast("long"))


def _rounded(num: Column, den: Column, m: int) -> Column:
    """floor(m * num / den + 1/2) for num >= 0 and den > 0."""
    whole = idiv(num, den)
    wide = lambda c: c.cast("decimal(19,0)")
    rest = wide(num - whole * den) * F.lit(2 * m).cast("decimal(12,0)") + wide(den)
    part = F.call_function("div", rest, wide(den) * F.lit(2).cast("decimal(1,0)"))
    return whole * F.lit(m) + part


def round_half_up_ratio(num, den, scale: int = 2, factor: int = 1) -> Column:
    """round(factor * num / den, scale) for num >= 0; null unless den > 0."""
    num, den = _col(num).cast("long"), _col(den).cast("long")
    rounded = _rounded(num, F.when(den > 0, den), 10 ** scale * factor)
    return F.when(den > 0, rounded.cast("double") / F.lit(float(10 ** scale)))


def round_half_away_ratio(num, den, scale: int = 2, factor: int = 1) -> Column:
    """round(factor * num / den, scale), half away from zero, any sign of num."""
    num, den = _col(num).cast("long"), _col(den).cast("long")
    mag = _rounded(F.abs(num), F.when(den > 0, den), 10 ** scale * factor)
    signed = F.when(num < 0, -mag).otherwise(mag)
    return F.when(den > 0, signed.cast("double") / F.lit(float(10 ** scale)))


def micros_between(start: Column, end: Column) -> Column:
    """Whole microseconds from ``start`` to ``end``."""
    return F.timestamp_diff("MICROSECOND", start, end)


def seconds_from_micros(us: Column, scale: int = 2) -> Column:
    """``ROUND(EXTRACT(EPOCH FROM interval), scale)`` for a non-negative span."""
    return round_half_up_ratio(us, F.lit(1_000_000), scale)
