"""Calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.functions import date_key


def _days(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day`` of a one-row frame."""
    one_day = F.expr("interval 1 day")
    return bounds.select(
        F.explode(F.sequence("first_day", "last_day", one_day)).alias("calendar_date")
    )


def _describe(days: DataFrame) -> DataFrame:
    d: Column = F.col("calendar_date")
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).alias("day_of_week"),
        F.quarter(d).alias("quarter"),
        F.when(F.dayofweek(d).isin(1, 7), 1).otherwise(0).alias("is_weekend"),
    )


def calendar(spark: SparkSession, first_day: date, last_day: date) -> DataFrame:
    """Days between two given dates: a few thousand rows, whatever the data size."""
    bounds = spark.range(1).select(
        F.lit(first_day).alias("first_day"), F.lit(last_day).alias("last_day")
    )
    return _describe(_days(bounds))


def calendar_covering(orders: DataFrame) -> DataFrame:
    """Whole months around every purchase, delivery and promised date in the data."""
    dates = [
        F.to_date(c)
        for c in (
            "order_purchase_timestamp",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        )
    ]
    bounds = orders.agg(
        F.trunc(F.min(F.least(*dates)), "MM").alias("first_day"),
        F.last_day(F.max(F.greatest(*dates))).alias("last_day"),
    )
    return _describe(_days(bounds))
