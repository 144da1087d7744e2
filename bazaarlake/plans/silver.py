"""Cleansing: raw tables to typed, quote-free tables.

Each builder takes ``raw``, a function from table name to raw DataFrame. All of them
are narrow maps except the geolocation average and the product category lookup.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake import fixed_values as fv
from bazaarlake.functions import blank_to_default, blank_to_null, strip_quotes
from bazaarlake.operators.lookup import lookup_with_fallback
from bazaarlake.sources.schemas import SILVER, conform

Tables = Callable[[str], DataFrame]


def _stripped(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: strip_quotes(c) for c in columns})


def product_category_translation(raw: Tables) -> DataFrame:
    return raw("category_translation").select(
        strip_quotes("product_category_name").alias("product_category_name_pt"),
        strip_quotes("product_category_name_english").alias("product_category_name_eng"),
    )


def customers(raw: Tables) -> DataFrame:
    df = raw("customers")
    return _stripped(df, *SILVER["customers"].names)


def geolocation(raw: Tables) -> DataFrame:
    """One point per zip prefix: the mean of its samples that lie inside the bounds."""
    zip_code = "geolocation_zip_code_prefix"
    inside = F.col("geolocation_lat").between(*fv.LATITUDE_BOUNDS) & F.col(
        "geolocation_lng"
    ).between(*fv.LONGITUDE_BOUNDS)
    return (
        raw("geolocation")
        .filter(inside)
        .groupBy(strip_quotes(zip_code).alias(zip_code))
        .agg(
            F.avg("geolocation_lat").alias("geolocation_lat"),
            F.avg("geolocation_lng").alias("geolocation_lng"),
        )
    )


def order_items(raw: Tables) -> DataFrame:
    return _stripped(raw("order_items"), "order_id", "product_id", "seller_id")


def order_payments(raw: Tables) -> DataFrame:
    """Payments with a known type; an undefined or missing type carries no information."""
    return _stripped(raw("order_payments"), "order_id", "payment_type").filter(
        F.col("payment_type") != fv.UNDEFINED_PAYMENT
    )


def order_reviews(raw: Tables) -> DataFrame:
    return _stripped(raw("order_reviews"), "review_id", "order_id")


def orders(raw: Tables) -> DataFrame:
    """Missing timestamps stay NULL: the order has not reached that stage."""
    return _stripped(raw("orders"), "order_id", "customer_id", "order_status")


def products(raw: Tables, translation: DataFrame) -> DataFrame:
    """Category in both languages; English falls back to the original, then a default."""
    category = strip_quotes("product_category_name")
    return lookup_with_fallback(
        raw("products")
        .select("product_id", "product_category_name")
        .withColumn("product_id", strip_quotes("product_id")),
        translation,
        key=category,
        lookup_key="product_category_name_pt",
        value="product_category_name_eng",
        out="product_category_name_eng",
        fallbacks=[blank_to_null(category), F.lit(fv.NO_CATEGORY)],
        spread=["product_id"],
    ).withColumn("product_category_name_pt", blank_to_default(category, fv.NO_CATEGORY))


def sellers(raw: Tables) -> DataFrame:
    df = raw("sellers")
    return _stripped(df, *SILVER["sellers"].names)


_BUILDERS = {
    "product_category_translation": product_category_translation,
    "customers": customers,
    "geolocation": geolocation,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "orders": orders,
    "sellers": sellers,
}


def build_silver(name: str, raw: Tables, translation: DataFrame | None = None) -> DataFrame:
    """Cleansed table ``name`` with its declared schema.

    ``translation`` is the cleansed category lookup; left out, it is derived from raw.
    """
    if name == "products":
        lookup = translation
        if lookup is None:
            lookup = build_silver("product_category_translation", raw)
        df = products(raw, lookup)
    else:
        df = _BUILDERS[name](raw)
    return conform(df, SILVER[name])
