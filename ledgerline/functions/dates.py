"""Date expressions.  The reference day is always passed in, never read from the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def day(value: dt.date | str) -> Column:
    return F.lit(value).cast("date")


def months_before(as_of: dt.date, months: int) -> dt.date:
    """Same day some months earlier, clipped to the end of a shorter month (plan time)."""
    index = as_of.year * 12 + as_of.month - 1 - months
    year, month = divmod(index, 12)
    first_of_next = dt.date(year + (month == 11), (month + 1) % 12 + 1, 1)
    last = (first_of_next - dt.timedelta(days=1)).day
    return dt.date(year, month + 1, min(as_of.day, last))


def month_difference(later: Column, earlier: Column) -> Column:
    """Whole calendar months between two dates, ignoring the day of month."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def date_parts(c: Column, prefix: str = "billing") -> dict[str, Column]:
    return {
        f"{prefix}_year": F.year(c),
        f"{prefix}_month": F.month(c),
        f"{prefix}_weekofyear": F.weekofyear(c),
        f"{prefix}_dayofyear": F.dayofyear(c),
    }
