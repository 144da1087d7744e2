"""Sales and growth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions import pct, ratio
from bazaarlake.operators.periods import period_over_period, same_period_last_year
from bazaarlake.operators.shares import pct_of_total
from bazaarlake.operators.topk import top_k
from bazaarlake.plans.questions.common import in_months, until_month
from bazaarlake.plans.warehouse import Warehouse


def _orders() -> Column:
    return F.count(F.lit(1)).alias("orders")


def _revenue() -> Column:
    return F.sum("items_value").alias("revenue")


def monthly_sales_growth(wh: Warehouse) -> DataFrame:
    """Orders, revenue, order value and month-over-month growth."""
    sales = wh.fact_orders(valid_only=True, customer=False)
    window = in_months(sales, wh.params.months_from, wh.params.months_to)
    months = window.groupBy("purchase_month").agg(_orders(), _revenue())
    valued = months.withColumn("avg_order_value", ratio(F.col("revenue"), F.col("orders"), 2))
    return period_over_period(
        valued, "purchase_month", "revenue", "mom_growth_pct"
    ).orderBy("purchase_month")


def yoy_revenue(wh: Warehouse) -> DataFrame:
    """Revenue against the same month one year earlier."""
    sales = wh.fact_orders(valid_only=True, customer=False)
    months = (
        until_month(sales, wh.params.yoy_until).groupBy("purchase_month").agg(_revenue())
    )
    paired = same_period_last_year(months, "purchase_month", "revenue")
    before = F.col("revenue_same_month_last_year")
    return paired.withColumn(
        "yoy_growth_pct", pct(F.col("revenue") - before, before, 1)
    ).orderBy("purchase_month")


def status_funnel(wh: Warehouse) -> DataFrame:
    """Share of all orders per status, with or without items."""
    counts = wh.silver("orders").groupBy("order_status").agg(_orders())
    return pct_of_total(counts, "orders", "pct_of_orders", 2).orderBy(
        F.col("orders").desc(), "order_status"
    )


def weekday_profile(wh: Warehouse) -> DataFrame:
    """Orders and revenue per weekday, whether or not the calendar holds the day."""
    sales = wh.fact_orders(valid_only=True, customer=False)
    return (
        sales.filter(F.col("purchase_date").isNotNull())
        .groupBy(
            F.dayofweek("purchase_date").alias("day_of_week"),
            F.date_format("purchase_date", "EEEE").alias("day_name"),
        )
        .agg(_orders(), _revenue())
        .orderBy("day_of_week")
    )


def hour_profile(wh: Warehouse) -> DataFrame:
    """Orders per hour of day; hours without orders are absent."""
    sales = wh.fact_orders(valid_only=True, customer=False)
    hour = F.hour("order_purchase_timestamp").alias("hour_of_day")
    return sales.groupBy(hour).agg(_orders()).orderBy("hour_of_day")


def top_sale_days(wh: Warehouse) -> DataFrame:
    """Days with the most orders."""
    sales = wh.fact_orders(valid_only=True, customer=False)
    days = sales.groupBy("purchase_date").agg(_orders(), _revenue())
    return top_k(days, wh.params.top_days, [F.col("orders").desc()], ["purchase_date"])
