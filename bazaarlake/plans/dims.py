"""Dimensions. Keys run 1..N in the order of the source id and hold for one run only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.operators.lookup import lookup_join
from bazaarlake.operators.ranking import add_surrogate_key


def _located(df: DataFrame, zip_code: str, spread: str, geolocation: DataFrame) -> DataFrame:
    """Coordinates by zip prefix; NULL, and flagged, where the zip is unknown."""
    points = geolocation.withColumnRenamed("geolocation_zip_code_prefix", zip_code)
    return lookup_join(df, points, zip_code, "left", spread=[spread]).select(
        *df.columns,
        "geolocation_lat",
        "geolocation_lng",
        F.when(F.col("geolocation_lat").isNull(), 0).otherwise(1).alias("has_geolocation"),
    )


def locate_customers(customers: DataFrame, geolocation: DataFrame) -> DataFrame:
    return _located(customers, "customer_zip_code_prefix", "customer_id", geolocation)


def locate_sellers(sellers: DataFrame, geolocation: DataFrame) -> DataFrame:
    return _located(sellers, "seller_zip_code_prefix", "seller_id", geolocation)


def dim_customers(customers: DataFrame, geolocation: DataFrame) -> DataFrame:
    keyed = add_surrogate_key(customers, "customer_key", "customer_id")
    return locate_customers(keyed, geolocation)


def dim_products(products: DataFrame) -> DataFrame:
    return add_surrogate_key(
        products.select(
            "product_id", "product_category_name_pt", "product_category_name_eng"
        ),
        "product_key",
        "product_id",
    )


def dim_sellers(sellers: DataFrame, geolocation: DataFrame) -> DataFrame:
    keyed = add_surrogate_key(sellers, "seller_key", "seller_id")
    return locate_sellers(keyed, geolocation)
