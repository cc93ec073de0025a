"""Money and ratio arithmetic with exact half-up rounding.

Money is ``decimal(18,2)``; sums stay exact decimals.  A rounded ratio is
computed with integer division on exact decimals,

    round_half_up(n / d, s) = sign * floor((2 * |n| * 10^s + |d|) / (2 * |d|)) / 10^s

so no intermediate decimal rounding (Spark keeps only a few extra digits in
``avg`` and ``/``) can move a value across a .5 boundary.  The result is a
double, the type every final ratio and amount is reported in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)
_WIDE_INT = DecimalType(38, 0)


def to_money(col: Column | str) -> Column:
    """Cast an amount to ``decimal(18,2)`` (half-up to cents)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(MONEY)


def amount(col: Column | str) -> Column:
    """Report an exact decimal amount as double."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("double")


def _exact_floor_div(x: Column, y: Column) -> Column:
    # x >= 0, y > 0, both exact decimals: (x - x % y) / y is an exact integer
    # quotient, so the decimal division cannot round.
    return ((x - (x % y)) / y).cast(_WIDE_INT)


def half_up(num: Column, den: Column, scale: int) -> Column:
    """``round(num / den, scale)`` half away from zero, exactly; NULL if den is 0 or NULL."""
    n = num.cast(DecimalType(38, 6))
    d = den.cast(DecimalType(38, 6))
    p = 10 ** scale
    q = _exact_floor_div(F.abs(n) * 2 * p + F.abs(d), F.abs(d) * 2)
    value = q.cast("double") / F.lit(float(p))
    negative = ((n < 0) != (d < 0)) & (q > 0)  # never produce -0.0
    return F.when(d != 0, F.when(negative, -value).otherwise(value))


def avg_money(sum_col: Column, count_col: Column, scale: int = 2) -> Column:
    """Average as ``round(sum / count, scale)``; NULL when count is 0."""
    return half_up(sum_col, count_col, scale)


def pct(part: Column, whole: Column, scale: int = 1) -> Column:
    """``round(100 * part / whole, scale)``; NULL when whole is 0 (NULLIF guard)."""
    return half_up(part * 100, whole, scale)
