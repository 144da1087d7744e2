"""Pre-aggregation to order level, so that later joins cannot multiply rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_item_summary(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.count_distinct("seller_id").alias("seller_count"),
        F.sum("price").alias("items_value"),
        F.sum("freight_value").alias("freight_value"),
    )


def order_payment_summary(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("payment_value"),
        F.max("payment_installments").alias("max_installments"),
        F.count_distinct("payment_type").alias("payment_type_count"),
    )


def order_review_summary(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.avg(F.col("review_score").cast("decimal(4,2)")).alias("review_score")
    )


def items_per_order_and(items: DataFrame, group: str) -> DataFrame:
    """Item rows folded to one per order and ``group`` value.

    The fold happens on the map side first, so an order with very many items reaches
    the join by ``order_id`` as at most one row per group value.
    """
    return items.groupBy("order_id", group).agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("price").alias("price"),
        F.count("price").alias("prices"),
        F.sum("freight_value").alias("freight_value"),
        F.count("freight_value").alias("freights"),
    )
