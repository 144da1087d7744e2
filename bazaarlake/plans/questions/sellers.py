"""Sellers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions import pct, ratio
from bazaarlake.operators.hot_keys import folded_per_key
from bazaarlake.operators.lookup import lookup_join
from bazaarlake.operators.ranking import global_ntile
from bazaarlake.operators.rollups import items_per_order_and
from bazaarlake.operators.scorecard import scorecard
from bazaarlake.operators.shares import pct_of_total, share_full_outer
from bazaarlake.operators.topk import ranked_top_k
from bazaarlake.plans.questions.common import LINE_ID, kept_lines
from bazaarlake.plans.warehouse import Warehouse


def _sold(wh: Warehouse) -> tuple[DataFrame, Column]:
    """Lines of valid orders by order and seller with their sums, and how to count orders."""
    fact, orders = wh.loaded("fact_order_items"), wh.order_outcomes()
    score, late = F.col("review_score"), F.col("is_late")
    if fact is None or wh.loaded("fact_orders") is None:
        lines = items_per_order_and(wh.silver("order_items"), "seller_id")
        items = F.col("items")
        sold = lines.join(orders, "order_id").withColumns(
            {
                "score": score * items,
                "scored": F.when(score.isNotNull(), items),
                "late": late * items,
            }
        )
        return sold, F.count_distinct("order_id")
    sellers = wh.gold("dim_sellers").select("seller_key", "seller_id")
    lines = lookup_join(
        fact.select(*LINE_ID, "seller_key", "price"), sellers, "seller_key", "inner", LINE_ID
    )
    sold = folded_per_key(
        lines.select("order_id", "seller_id", "price"),
        "order_id",
        "seller_id",
        orders,
        wh.hot_orders(),
        F.count(F.lit(1)).alias("items"),
        F.sum("price").alias("price"),
        F.sum(score).alias("score"),
        F.count(score).alias("scored"),
        F.sum(late).alias("late"),
    )
    # One row per order and seller.
    return sold, F.count("order_id")


def _seller_performance(wh: Warehouse, min_orders: int) -> DataFrame:
    """Orders, revenue, review score and lateness of sellers with enough orders."""
    sold, orders = _sold(wh)
    performance = scorecard(
        sold,
        "seller_id",
        orders,
        min_orders,
        [
            F.sum("price").alias("revenue"),
            ratio(F.sum("score"), F.sum("scored"), 2).alias("avg_review"),
            pct(F.sum("late"), F.sum("items"), 1).alias("late_pct"),
        ],
    )
    sellers = wh.silver("sellers").select("seller_id", "seller_state")
    return performance.join(sellers, "seller_id")


def seller_scorecard(wh: Warehouse) -> DataFrame:
    """Best sellers by revenue, ranked."""
    performance = _seller_performance(wh, wh.params.min_seller_orders)
    ranked = ranked_top_k(
        performance, wh.params.top_sellers, "revenue", ["seller_id"], "revenue_rank"
    )
    return ranked.select(
        "revenue_rank", "seller_id", "seller_state", "orders", "revenue", "avg_review", "late_pct"
    ).orderBy("revenue_rank", "seller_id")


def seller_deciles(wh: Warehouse) -> DataFrame:
    """Concentration of revenue: sellers in ten equal groups, richest first."""
    known = wh.silver("sellers").select("seller_id", F.lit(True).alias("_known"))
    revenue = (
        kept_lines(wh, "seller_id")
        .groupBy("seller_id")
        .agg(F.sum("price").alias("revenue"))
        # Sellers the dimension does not know share one group, as they share no key.
        .join(known, "seller_id", "left")
        .groupBy(F.when(F.col("_known"), F.col("seller_id")).alias("seller_id"))
        .agg(F.sum("revenue").alias("revenue"))
    )
    tiled = global_ntile(
        revenue, wh.params.seller_tiles, "decile", [F.col("revenue").desc(), F.col("seller_id")]
    )
    deciles = tiled.groupBy("decile").agg(
        F.count(F.lit(1)).alias("sellers"), F.sum("revenue").alias("revenue")
    )
    return pct_of_total(deciles, "revenue", "share_of_revenue_pct", 1).orderBy("decile")


def sellers_at_risk(wh: Warehouse) -> DataFrame:
    """Sellers with too many late or badly reviewed orders, by revenue."""
    performance = _seller_performance(wh, wh.params.min_at_risk_orders)
    at_risk = (F.col("late_pct") > wh.params.at_risk_late_pct) | (
        F.col("avg_review") < wh.params.at_risk_review
    )
    return (
        performance.filter(at_risk)
        .select("seller_id", "seller_state", "orders", "revenue", "avg_review", "late_pct")
        .orderBy(F.col("revenue").desc(), "seller_id")
    )


def supply_demand(wh: Warehouse) -> DataFrame:
    """Sellers against customers per state, each as a share of its total."""
    supply = (
        wh.silver("sellers")
        .groupBy(F.col("seller_state").alias("state"))
        .agg(F.count_distinct("seller_id").alias("sellers"))
    )
    demand = (
        wh.silver("customers")
        .groupBy(F.col("customer_state").alias("state"))
        .agg(F.count_distinct("customer_unique_id").alias("customers"))
    )
    return share_full_outer(demand, supply, "state", ("customers", "sellers")).orderBy(
        F.col("demand_share_pct").desc(), "state"
    )
