"""Calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def month_label(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def months_between_starts(later: Column, earlier: Column) -> Column:
    """Whole calendar months from one month to another."""
    return (
        (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
    ).cast("int")


def last_complete_month(last_day: Column) -> Column:
    """Month of last_day when it is a month-end, else the month before."""
    start = month_start(last_day)
    return F.when(last_day == F.last_day(last_day), start).otherwise(
        F.add_months(start, -1)
    )
