"""Data quality rules, one row per rule: rows that break it, rows looked at."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake import fixed_values as fv
from bazaarlake.functions import blank_to_null, strip_quotes
from bazaarlake.operators.checks import grain_check, rule
from bazaarlake.plans.dims import locate_customers, locate_sellers
from bazaarlake.plans.facts import DELIVERED_AT, PURCHASED
from bazaarlake.plans.warehouse import Warehouse


def _category():
    return blank_to_null(strip_quotes("product_category_name"))


def missing_category(wh: Warehouse) -> DataFrame:
    return rule(wh.raw("products"), "products", "missing_category", _category().isNull())


def untranslated_category_names(wh: Warehouse) -> DataFrame:
    """The categories without an English name, and how many products carry them."""
    names = (
        wh.raw("products")
        .select(_category().alias("category"))
        .filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("products"))
    )
    known = wh.silver("product_category_translation").select(
        F.col("product_category_name_pt").alias("category")
    )
    return names.join(known, "category", "left_anti")


def untranslated_categories(wh: Warehouse) -> DataFrame:
    names = wh.raw("products").select(_category().alias("category")).distinct()
    known = (
        wh.silver("product_category_translation")
        .select(F.col("product_category_name_pt").alias("category"))
        .distinct()
        .withColumn("_known", F.lit(True))
    )
    return rule(
        names.filter(F.col("category").isNotNull()).join(known, "category", "left"),
        "products",
        "untranslated_category",
        F.col("_known").isNull(),
    )


def missing_geolocation(wh: Warehouse) -> DataFrame:
    points = wh.silver("geolocation")
    unplaced = F.col("has_geolocation") == 0
    customers = locate_customers(wh.silver("customers"), points)
    sellers = locate_sellers(wh.silver("sellers"), points)
    return rule(customers, "customers", "missing_geolocation", unplaced).union(
        rule(sellers, "sellers", "missing_geolocation", unplaced)
    )


def delivered_without_date(wh: Warehouse) -> DataFrame:
    undated = (F.col("order_status") == fv.DELIVERED) & F.col(DELIVERED_AT).isNull()
    return rule(wh.silver("orders"), "orders", "delivered_without_date", undated)


def outside_calendar(wh: Warehouse) -> DataFrame:
    """Orders bought on a day the calendar does not hold; line facts have no date key for them."""
    outside = ~F.to_date(PURCHASED).between(
        F.lit(wh.params.calendar_from), F.lit(wh.params.calendar_to)
    )
    return rule(wh.silver("orders"), "orders", "outside_calendar", outside)


def undefined_payments(wh: Warehouse) -> DataFrame:
    undefined = strip_quotes("payment_type") == fv.UNDEFINED_PAYMENT
    return rule(wh.raw("order_payments"), "order_payments", "undefined_payment", undefined)


def zero_weight(wh: Warehouse) -> DataFrame:
    return rule(wh.raw("products"), "products", "zero_weight", F.col("product_weight_g") == 0)


def duplicate_geolocation(wh: Warehouse) -> DataFrame:
    """Raw samples that repeat an earlier one in every column."""
    samples = wh.raw("geolocation")
    per_sample = samples.groupBy(*samples.columns).agg(F.count(F.lit(1)).alias("_n"))
    return per_sample.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("failing_rows"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
    ).select(
        F.lit("geolocation").alias("table_name"),
        F.lit("duplicate_sample").alias("rule_name"),
        "failing_rows",
        "total_rows",
    )


RULES = (
    missing_category,
    untranslated_categories,
    missing_geolocation,
    delivered_without_date,
    outside_calendar,
    undefined_payments,
    zero_weight,
    duplicate_geolocation,
)


def quality_report(wh: Warehouse) -> DataFrame:
    """All rules in one table."""
    return reduce(DataFrame.unionByName, [check(wh) for check in RULES])


# What makes a row of each table unique.
GRAINS = {
    "customers": ["customer_id"],
    "geolocation": ["geolocation_zip_code_prefix"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id", "order_id"],
    "orders": ["order_id"],
    "product_category_translation": ["product_category_name_pt"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
}


def grain_report(wh: Warehouse) -> DataFrame:
    """Rows against distinct keys for every cleansed table, and for the order facts."""

    def check(table: str, df: DataFrame, keys: list[str]) -> DataFrame:
        counts = grain_check(df, keys, "row_count", "distinct_keys")
        return counts.select(F.lit(table).alias("table_name"), "row_count", "distinct_keys")

    checks = [check(table, wh.silver(table), keys) for table, keys in GRAINS.items()]
    checks.append(check("fact_orders", wh.fact_orders(), ["order_id"]))
    return reduce(DataFrame.unionByName, checks)


def fact_orders_grain(wh: Warehouse) -> DataFrame:
    return grain_check(wh.fact_orders(), ["order_id"], "rows_in_view", "distinct_orders")
