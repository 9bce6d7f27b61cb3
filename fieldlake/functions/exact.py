"""Exact money arithmetic as column expressions.

Double sums depend on the order partitions are combined in, and
``round(avg(double), 2)`` rounds differently across engines. Money is
therefore summed as decimals of eight places. Sums, averages and ratios are
fractions of such sums until the end, where one integer division rounds them,
halves away from zero; so the result is the same on any partitioning and in any
engine, and nothing is rounded twice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def units(x: Column, scale: int = 2) -> Column:
    """Value as an integer count of 10**-scale units (cents for scale 2)."""
    return F.round(x * (10 ** scale)).cast("long")


def sum_exact(x: Column) -> Column:
    """Aggregate: the sum as a decimal of 8 places, not rounded."""
    return F.sum(x.try_cast("decimal(30,8)"))


PLACES = 8  # of a sum; it may have 18 digits before them


def parts(total: Column) -> Column:
    """A sum as a whole number of 10**-8 units."""
    return (total.cast("decimal(26,8)") * F.lit(10 ** PLACES)).cast("decimal(38,0)")


def ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """round(num / den, scale) of two whole numbers as a double; NULL unless
    ``den`` is positive."""
    return F.when(den > 0, from_units(div_half_up(num * F.lit(10 ** scale), den), scale))


def rounded_units(total: Column, scale: int = 2) -> Column:
    """A decimal in 10**-scale units (BIGINT), halves away from zero."""
    return (F.round(total, scale) * (10 ** scale)).cast("long")


def sum_units(x: Column, scale: int = 2) -> Column:
    """Aggregate: the sum of ``x``, rounded once, in 10**-scale units (BIGINT)."""
    return rounded_units(sum_exact(x), scale)


def from_units(u: Column, scale: int = 2) -> Column:
    """Integer units back to a double with ``scale`` decimals."""
    return u.cast("double") / (10 ** scale)


def div_half_up(num: Column, den: Column) -> Column:
    """round(num / den) to an integer, halves away from zero, exactly.

    ``den`` must be positive. Decimals of 38 digits keep it exact.
    """
    n = num.cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    a = F.abs(n) * 2 + d
    q = ((a - F.pmod(a, d * 2)) / (d * 2)).cast("long")
    return F.when(n < 0, -q).otherwise(q)


def money_sum(x: Column) -> Column:
    """Aggregate: ROUND(SUM(x), 2) computed exactly."""
    return from_units(sum_units(x, 2), 2)


def money_avg(x: Column, scale: int = 2) -> Column:
    """Aggregate: ROUND(AVG(x), scale), rounded once (nulls ignored)."""
    return ratio(parts(sum_exact(x)), F.count(x) * F.lit(10 ** PLACES), scale)


def ratio_pct(part: Column, whole: Column) -> Column:
    """ROUND(100 * part / whole, 2) for integer counts; NULL when whole is 0."""
    return F.when(whole > 0, from_units(div_half_up(part * 10000, whole), 2))
