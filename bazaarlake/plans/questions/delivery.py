"""Delivery performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake import fixed_values as fv
from bazaarlake.functions import (
    band,
    days_between,
    mean_of,
    pct,
    pct_where,
    ratio,
    rounded,
    weighted_mean,
)
from bazaarlake.operators.lookup import lookup_join
from bazaarlake.operators.rollups import items_per_order_and
from bazaarlake.operators.scorecard import scorecard
from bazaarlake.operators.shares import pct_of_total
from bazaarlake.plans.facts import DELIVERED_AT, PROMISED_AT, PURCHASED
from bazaarlake.plans.questions.common import LINE_ID, delivered_orders, in_months
from bazaarlake.plans.warehouse import Warehouse


def _deliveries() -> Column:
    return F.count(F.lit(1)).alias("delivered_orders")


def _avg_days() -> Column:
    return mean_of("delivery_days", 1).alias("avg_delivery_days")


def _late_pct(places: int) -> Column:
    return pct_where(F.col("is_late") == 1, places).alias("late_pct")


def delivery_kpis(wh: Warehouse) -> DataFrame:
    """Overall delivery time, delay and lateness, in one row."""
    return delivered_orders(wh).agg(
        _deliveries(),
        _avg_days(),
        mean_of("delay_days", 1).alias("avg_delay_days"),
        _late_pct(2),
    )


def state_late_rate(wh: Warehouse) -> DataFrame:
    """Lateness per customer state with enough deliveries, worst first."""
    return (
        scorecard(
            delivered_orders(wh, customer=True),
            "customer_state",
            F.count(F.lit(1)),
            wh.params.min_state_orders,
            [_avg_days(), _late_pct(1), mean_of("review_score", 2).alias("avg_review")],
            "delivered_orders",
        )
        .orderBy(F.col("late_pct").desc(), "customer_state")
    )


def review_by_delay(wh: Warehouse) -> DataFrame:
    """Review score per delay bucket, over reviewed deliveries."""
    bucket = band(
        F.col("delay_days"), fv.DELAY_BUCKET_EDGES, fv.DELAY_BUCKET_LABELS, closed="right"
    )
    return (
        delivered_orders(wh)
        .filter(F.col("review_score").isNotNull())
        .groupBy(bucket.alias("delay_bucket"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            mean_of("review_score", 2).alias("avg_review"),
            pct_where(F.col("review_score") <= 2, 1).alias("pct_1_or_2_star"),
        )
        .orderBy("delay_bucket")
    )


def state_promise_buffer(wh: Warehouse) -> DataFrame:
    """Promised days, actual days and the buffer between, per customer state."""
    promised = days_between(PURCHASED, PROMISED_AT)
    sums = (
        delivered_orders(wh, customer=True)
        .groupBy("customer_state")
        .agg(
            _deliveries(),
            F.sum(promised).alias("_promised"),
            F.count(promised).alias("_promises"),
            F.sum("delivery_days").alias("_actual"),
            F.count("delivery_days").alias("_actuals"),
        )
        .filter(F.col("delivered_orders") >= wh.params.min_state_orders)
    )
    def mean(total: str, n: str) -> Column:
        return F.col(total).cast("double") / F.nullif(F.col(n).cast("double"), F.lit(0.0))

    buffer = rounded(mean("_promised", "_promises") - mean("_actual", "_actuals"), 1)
    return sums.select(
        "customer_state",
        "delivered_orders",
        ratio(F.col("_promised"), F.col("_promises"), 1).alias("avg_promised_days"),
        ratio(F.col("_actual"), F.col("_actuals"), 1).alias("avg_actual_days"),
        buffer.alias("avg_buffer_days"),
    ).orderBy("avg_buffer_days", "customer_state")


def late_trend(wh: Warehouse) -> DataFrame:
    """Lateness and delivery time per purchase month."""
    window = in_months(delivered_orders(wh), wh.params.months_from, wh.params.months_to)
    return (
        window.groupBy("purchase_month")
        .agg(_deliveries(), _late_pct(1), _avg_days())
        .orderBy("purchase_month")
    )


def route_type(wh: Warehouse) -> DataFrame:
    """Items that stay in the customer's state against items that cross states."""
    deliveries = (
        wh.silver("orders")
        .filter(F.col("order_status") == fv.DELIVERED)
        .withColumn("delivery_days", days_between(PURCHASED, DELIVERED_AT))
        .withColumn("delay_days", days_between(PROMISED_AT, DELIVERED_AT))
        .filter(F.col("delivery_days").isNotNull())
        .select("order_id", "customer_id", "delivery_days", "delay_days")
        .join(wh.silver("customers").select("customer_id", "customer_state"), "customer_id")
    )
    sellers = wh.silver("sellers").select("seller_id", "seller_state")
    items = lookup_join(wh.silver("order_items"), sellers, "seller_id", "inner", LINE_ID)
    lines = items_per_order_and(items, "seller_state")
    same_state = F.col("customer_state") == F.col("seller_state")
    late = F.when(F.col("delay_days") > 0, F.col("items")).otherwise(0)
    routes = (
        lines.join(deliveries, "order_id")
        .groupBy(
            F.when(same_state, fv.SAME_STATE).otherwise(fv.CROSS_STATE).alias("route_type")
        )
        .agg(
            F.sum("items").alias("items"),
            weighted_mean(F.col("delivery_days"), F.col("items"), 1).alias("avg_delivery_days"),
            pct(F.sum("freight_value"), F.sum("price"), 1).alias("freight_pct_of_price"),
            pct(F.sum(late), F.sum("items"), 1).alias("late_pct"),
        )
    )
    return pct_of_total(routes, "items", "pct_of_items", 1).orderBy("route_type")
