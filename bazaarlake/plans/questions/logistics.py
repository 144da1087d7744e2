"""Logistics cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions import mean_of, pct, ratio
from bazaarlake.operators.scorecard import scorecard
from bazaarlake.operators.topk import top_k
from bazaarlake.plans.questions.common import kept_lines
from bazaarlake.plans.warehouse import Warehouse


def state_freight_burden(wh: Warehouse) -> DataFrame:
    """Freight per order and relative to goods value, per customer state."""
    return (
        scorecard(
            wh.fact_orders(valid_only=True),
            "customer_state",
            F.count(F.lit(1)),
            wh.params.min_state_orders,
            [
                mean_of("freight_value", 2).alias("avg_freight"),
                pct(F.sum("freight_value"), F.sum("items_value"), 1).alias(
                    "freight_pct_of_price"
                ),
            ],
        ).orderBy(F.col("freight_pct_of_price").desc(), "customer_state")
    )


def category_freight_burden(wh: Warehouse) -> DataFrame:
    """Categories with enough items and the highest freight burden."""
    burden = scorecard(
        kept_lines(wh, "category"),
        "category",
        F.sum("items"),
        wh.params.min_category_items,
        [
            ratio(F.sum("price"), F.sum("prices"), 2).alias("avg_price"),
            ratio(F.sum("freight_value"), F.sum("freights"), 2).alias("avg_freight"),
            pct(F.sum("freight_value"), F.sum("price"), 1).alias("freight_pct_of_price"),
        ],
        "items_sold",
    )
    return top_k(
        burden,
        wh.params.top_freight_categories,
        [F.col("freight_pct_of_price").desc()],
        ["category"],
    )
