"""Sums that do not depend on the order of addition where the values allow it, and never round one.

A sum of doubles changes in its last digits with the order in which tasks finish, and more so
the more rows it has.  Where every value has at most ``scale`` decimals the values are therefore
added up as whole units of the last decimal, in two longs whose sums stay far from the range of a
long.  If any value has more decimals, is too large for that, or is no number, the plain sum of
the doubles is the result; no value is rounded to make it fit.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_LOW_BITS = 20
_MOST_UNITS = 2.0**62  # fits into a long
_NOISE = 1e-14, 1e-15  # relative and absolute error of a double that stands for a decimal


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fits(c: Column | str, scale: int) -> Column:
    """Has the value at most ``scale`` decimals, up to the error of a double, and few enough digits?
    Null counts as yes."""
    c = _column(c).cast("double")
    units = F.rint(c * F.lit(float(10**scale)))
    off = F.abs(units / F.lit(float(10**scale)) - c)
    relative, absolute = _NOISE
    return c.isNull() | ((F.abs(units) < _MOST_UNITS) & (off <= F.abs(c) * relative + absolute))


def total_units(c: Column | str, scale: int) -> Column:
    """Aggregate: the total as a struct that :func:`add_totals` adds and :func:`from_units` reads."""
    c = _column(c)
    whole = F.when(fits(c, scale), F.rint(c * F.lit(float(10**scale)))).cast("long")
    high = F.sum(F.shiftright(whole, _LOW_BITS)).cast("decimal(28,0)")
    low = F.sum(whole.bitwiseAND(F.lit(2**_LOW_BITS - 1))).cast("decimal(20,0)")
    return F.struct(
        (high * F.lit(2**_LOW_BITS) + low).cast("decimal(38,0)").alias("units"),
        F.sum(c.cast("double")).alias("plain"),
        F.bool_and(fits(c, scale)).alias("exact"),
    )


def add_totals(total: Column | str) -> Column:
    """Aggregate: the sum of totals."""
    t = _column(total)
    return F.struct(
        F.sum(t["units"]).cast("decimal(38,0)").alias("units"),
        F.sum(t["plain"]).alias("plain"),
        F.bool_and(t["exact"]).alias("exact"),
    )


def from_units(total: Column | str, scale: int) -> Column:
    t = _column(total)
    return F.when(t["exact"], t["units"].cast("double") / F.lit(float(10**scale))).otherwise(t["plain"])


def exact_sum(c: Column | str, scale: int = 4) -> Column:
    """Aggregate: sum of a column as a double, independent of order up to ``scale`` decimals."""
    return from_units(total_units(c, scale), scale)
