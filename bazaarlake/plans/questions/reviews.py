"""Experience and reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake import fixed_values as fv
from bazaarlake.functions import days_between, mean_of, pct_where, ratio
from bazaarlake.operators.shares import pct_of_total
from bazaarlake.plans.questions.common import delivered_orders
from bazaarlake.plans.warehouse import Warehouse


def multi_seller(wh: Warehouse) -> DataFrame:
    """Delivered orders with items of several sellers against the others."""
    order_type = F.when(F.col("seller_count") > 1, fv.MULTI_SELLER).otherwise(fv.SINGLE_SELLER)
    return (
        delivered_orders(wh)
        .groupBy(order_type.alias("order_type"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            mean_of("delivery_days", 1).alias("avg_delivery_days"),
            pct_where(F.col("is_late") == 1, 1).alias("late_pct"),
            mean_of("review_score", 2).alias("avg_review"),
        )
        .orderBy("order_type")
    )


def review_distribution(wh: Warehouse) -> DataFrame:
    """Reviews per score, and how long customers take to answer the survey."""
    fact = wh.loaded("fact_reviews")
    reviews = wh.silver("order_reviews") if fact is None else fact
    answer_days = days_between("review_creation_date", "review_answer_timestamp")
    # Folded per order and score first: an order with very many reviews reaches the join
    # as a few rows.
    per_order = reviews.groupBy("order_id", "review_score").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.sum(answer_days).alias("days"),
        F.count(answer_days).alias("answers"),
    )
    if fact is None:
        per_order = per_order.join(wh.silver("orders").select("order_id"), "order_id")
    scores = (
        per_order.groupBy("review_score")
        .agg(
            F.sum("reviews").alias("reviews"),
            ratio(F.sum("days"), F.sum("answers"), 1).alias("avg_days_to_answer_survey"),
        )
    )
    return pct_of_total(scores, "reviews", "pct_of_reviews", 1).orderBy("review_score")
