"""Products and categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake import fixed_values as fv
from bazaarlake.functions import band, mean_of, pct, pct_where, ratio, weighted_mean
from bazaarlake.operators.rollups import items_per_order_and
from bazaarlake.operators.scorecard import scorecard
from bazaarlake.operators.shares import pareto, pct_of_total
from bazaarlake.operators.topk import top_k
from bazaarlake.plans.questions.common import items_with_category, kept_lines
from bazaarlake.plans.warehouse import Warehouse


def _orders() -> Column:
    return F.count_distinct("order_id").alias("orders")


def _revenue() -> Column:
    return F.sum("price").alias("revenue")


def category_pareto(wh: Warehouse) -> DataFrame:
    """Revenue share and running share per category, largest first."""
    # Lines of the loaded fact are joined to no orders, so an order is there once per category.
    unique = wh.loaded("fact_order_items") is not None
    orders = F.count("order_id").alias("orders") if unique else _orders()
    revenue = kept_lines(wh, "category").groupBy("category").agg(orders, _revenue())
    return pareto(revenue, "revenue", ["category"], cutoff_pct=wh.params.pareto_cutoff_pct)


def category_scorecard(wh: Warehouse) -> DataFrame:
    """Largest categories: price, freight burden, review score of the items' orders."""
    lines = items_per_order_and(items_with_category(wh), "category")
    scored = lines.join(wh.order_outcomes(), "order_id").groupBy("category").agg(
        _orders(),
        _revenue(),
        ratio(F.sum("price"), F.sum("items"), 2).alias("avg_item_price"),
        pct(F.sum("freight_value"), F.sum("price"), 1).alias("freight_pct_of_price"),
        weighted_mean(F.col("review_score"), F.col("items"), 2).alias("avg_review"),
    )
    return top_k(scored, wh.params.top_categories, [F.col("revenue").desc()], ["category"])


def lowest_rated_categories(wh: Warehouse) -> DataFrame:
    """Categories with enough orders and the lowest review score, with their lateness."""
    lines = items_per_order_and(items_with_category(wh), "category")
    rated = scorecard(
        lines.join(wh.order_outcomes(), "order_id"),
        "category",
        F.count_distinct("order_id"),
        wh.params.min_category_orders,
        [
            weighted_mean(F.col("review_score"), F.col("items"), 2).alias("avg_review"),
            pct(F.sum(F.col("is_late") * F.col("items")), F.sum("items"), 1).alias("late_pct"),
        ],
    )
    return top_k(
        rated, wh.params.lowest_rated_categories, [F.col("avg_review").asc()], ["category"]
    )


def order_value_bands(wh: Warehouse) -> DataFrame:
    """Volume, freight burden, reviews and lateness per band of order value."""
    price_band = band(F.col("items_value"), fv.PRICE_BAND_EDGES, fv.PRICE_BAND_LABELS)
    bands = (
        wh.fact_orders(valid_only=True, customer=False)
        .groupBy(price_band.alias("price_band"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            pct(F.sum("freight_value"), F.sum("items_value"), 1).alias("freight_pct_of_price"),
            mean_of("review_score", 2).alias("avg_review"),
            pct_where(F.col("is_late") == 1, 1).alias("late_pct"),
        )
    )
    return pct_of_total(bands, "orders", "pct_of_orders", 1).orderBy("price_band")
