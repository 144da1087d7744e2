"""Inputs several reports share."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake import fixed_values as fv
from bazaarlake.operators.lookup import lookup_join
from bazaarlake.operators.rollups import items_per_order_and
from bazaarlake.plans.warehouse import Warehouse


# What tells the items of one product or seller apart, where a lookup has to spread them.
LINE_ID = ("order_id", "order_item_id")


def until_month(orders: DataFrame, last: date) -> DataFrame:
    """Orders bought in ``last`` or an earlier month.

    The test is on the timestamp itself, so a scan can skip row groups by it.
    """
    end = F.add_months(F.lit(last), 1).cast("timestamp_ntz")
    return orders.filter(F.col("order_purchase_timestamp") < end)


def in_months(orders: DataFrame, first: date, last: date) -> DataFrame:
    start = F.lit(first).cast("timestamp_ntz")
    return until_month(orders, last).filter(F.col("order_purchase_timestamp") >= start)


def delivered_orders(wh: Warehouse, customer: bool = False) -> DataFrame:
    return wh.fact_orders(customer=customer).filter(F.col("is_delivered") == 1)


def kept_orders(wh: Warehouse) -> DataFrame:
    """Ids of orders whose status is known and does not void the sale."""
    orders = wh.silver("orders")
    return orders.filter(~F.col("order_status").isin(*fv.NOT_A_SALE)).select("order_id")


def kept_status() -> Column:
    """Of a loaded fact: the order's status is known and does not void the sale."""
    return ~F.col("order_status").isin(*fv.NOT_A_SALE)


def kept_lines(wh: Warehouse, group: str) -> DataFrame:
    """Items of kept orders, folded to one row per order and ``group``.

    ``group`` is ``category`` or ``seller_id``; a seller no dimension knows is NULL in a
    loaded fact. The loaded fact has the status, so nothing is joined for it.
    """
    fact = wh.loaded("fact_order_items")
    if fact is None:
        items = items_with_category(wh) if group == "category" else wh.silver("order_items")
        return items_per_order_and(items, group).join(kept_orders(wh), "order_id")
    kept = fact.filter(kept_status())
    if group == "category":
        names = wh.gold("dim_products").select(
            "product_key", F.col("product_category_name_eng").alias("category")
        )
        keyed = lookup_join(kept, names, "product_key", "inner", LINE_ID)
    else:
        sellers = wh.gold("dim_sellers").select("seller_key", "seller_id")
        keyed = lookup_join(kept, sellers, "seller_key", "left", LINE_ID)
    return items_per_order_and(keyed, group)


def items_with_category(wh: Warehouse) -> DataFrame:
    return lookup_join(
        wh.silver("order_items"), wh.product_categories(), "product_id", "inner", LINE_ID
    )
