"""Comparisons between periods, on one row per period."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.functions import pct


def period_over_period(
    periods: DataFrame, period: str, measure: str, out: str, places: int = 1, lag: int = 1
) -> DataFrame:
    """Change in % against the ``lag``-th period present before (gaps are not filled)."""
    previous = F.lag(measure, lag).over(Window.orderBy(period))
    return periods.withColumn(out, pct(F.col(measure) - previous, previous, places))


def same_period_last_year(periods: DataFrame, period: str, measure: str) -> DataFrame:
    """Beside each month the value twelve months earlier; months without one drop.

    ``periods`` has one row per month, so the window sees as many rows as there are months.
    """
    month = F.year(period) * 12 + F.month(period)
    year_ago = Window.orderBy(month).rangeBetween(-12, -12)
    previous = f"{measure}_same_month_last_year"
    return (
        periods.withColumn(previous, F.max(measure).over(year_ago))
        .withColumn("_seen", F.count(F.lit(1)).over(year_ago))
        .where("_seen > 0")
        .drop("_seen")
    )
