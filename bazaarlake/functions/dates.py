"""Calendar arithmetic on whole days and months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_between(start: str | Column, end: str | Column) -> Column:
    """Midnights crossed from ``start`` to ``end`` (23:59 to 00:01 is one day)."""
    return F.datediff(F.to_date(end), F.to_date(start))


def month_start(ts: str | Column) -> Column:
    return F.trunc(F.to_date(ts), "MM")


def months_between_starts(start: Column, end: Column) -> Column:
    """Month boundaries crossed, whatever the day of month."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def date_key(d: Column) -> Column:
    """``2018-03-15`` to ``20180315``."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
