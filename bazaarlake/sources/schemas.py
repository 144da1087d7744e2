"""Declared schemas of the raw and cleansed tables. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
    "timestamp_ntz": TimestampNTZType(),
    "money": DecimalType(18, 2),
    "payment": DecimalType(18, 4),
    "degrees": DecimalType(18, 8),
}


def declared(columns: str) -> StructType:
    """``name type, ...`` as a schema of nullable columns."""
    pairs = [column.split() for column in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


# ---- fixed values: raw landing schemas (column spelling is the files' own) -------
BRONZE = {
    "category_translation": declared(
        "product_category_name string, product_category_name_english string"
    ),
    "customers": declared(
        "customer_id string, customer_unique_id string,"
        " customer_zip_code_prefix string, customer_city string, customer_state string"
    ),
    "geolocation": declared(
        "geolocation_zip_code_prefix string, geolocation_lat degrees,"
        " geolocation_lng degrees, geolocation_city string, geolocation_state string"
    ),
    "order_items": declared(
        "order_id string, order_item_id int, product_id string, seller_id string,"
        " shipping_limit_date timestamp_ntz, price money, freight_value money"
    ),
    "order_payments": declared(
        "order_id string, payment_sequential int, payment_type string,"
        " payment_installments int, payment_value money"
    ),
    "order_reviews": declared(
        "review_id string, order_id string, review_score int,"
        " review_comment_title string, review_comment_message string,"
        " review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz"
    ),
    "orders": declared(
        "order_id string, customer_id string, order_status string,"
        " order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,"
        " order_delivered_carrier_date timestamp_ntz,"
        " order_delivered_customer_date timestamp_ntz,"
        " order_estimated_delivery_date timestamp_ntz"
    ),
    "products": declared(
        "product_id string, product_category_name string, product_name_lenght int,"
        " product_description_lenght int, product_photos_qty int, product_weight_g int,"
        " product_length_cm int, product_height_cm int, product_width_cm int"
    ),
    "sellers": declared(
        "seller_id string, seller_zip_code_prefix string, seller_city string,"
        " seller_state string"
    ),
}

# ---- fixed values: cleansed schemas ----------------------------------------------
SILVER = {
    "product_category_translation": declared(
        "product_category_name_pt string, product_category_name_eng string"
    ),
    "customers": BRONZE["customers"],
    "geolocation": declared(
        "geolocation_zip_code_prefix string, geolocation_lat degrees,"
        " geolocation_lng degrees"
    ),
    "order_items": declared(
        "order_id string, order_item_id string, product_id string, seller_id string,"
        " shipping_limit_date timestamp_ntz, price money, freight_value money"
    ),
    "order_payments": declared(
        "order_id string, payment_sequential int, payment_type string,"
        " payment_installments int, payment_value payment"
    ),
    "order_reviews": declared(
        "review_id string, order_id string, review_score int,"
        " review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz"
    ),
    "orders": BRONZE["orders"],
    "products": declared(
        "product_id string, product_category_name_pt string,"
        " product_category_name_eng string"
    ),
    "sellers": BRONZE["sellers"],
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the declared columns, in order, with the declared types."""
    return df.selectExpr(
        *[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema]
    )
