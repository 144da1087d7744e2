"""Fact tables.

Line-level facts join their orders on ``order_id`` with both sides freshly shuffled,
the shape in which the adaptive skew join can split an order with very many lines.
The customer key is attached on the order side (one row per order) and the narrow
product and seller keys on the line side, before the wide order columns are added.
Where several facts are built, ``orders_with_customers`` does the former once for all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake import fixed_values as fv
from bazaarlake.functions import days_between, month_start
from bazaarlake.operators.lookup import lookup_join
from bazaarlake.operators.rollups import (
    order_item_summary,
    order_payment_summary,
    order_review_summary,
)

PURCHASED = "order_purchase_timestamp"
DELIVERED_AT = "order_delivered_customer_date"
PROMISED_AT = "order_estimated_delivery_date"


def is_delivered() -> Column:
    return (F.col("order_status") == fv.DELIVERED) & F.col(DELIVERED_AT).isNotNull()


def not_voided() -> Column:
    """Status is not one that voids the sale; an unknown status does not void it."""
    status = F.col("order_status")
    return status.isNull() | ~status.isin(*fv.NOT_A_SALE)


def is_late() -> Column:
    return is_delivered() & (F.to_date(DELIVERED_AT) > F.to_date(PROMISED_AT))


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


# -- order grain ---------------------------------------------------------------------

ORDER_COLUMNS = (
    "order_id",
    "order_status",
    "customer_id",
    "customer_unique_id",
    "customer_state",
    "customer_city",
    "order_purchase_timestamp",
    "purchase_date",
    "purchase_month",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "item_count",
    "seller_count",
    "items_value",
    "freight_value",
    "payment_value",
    "max_installments",
    "payment_type_count",
    "review_score",
    "is_delivered",
    "delivery_days",
    "delay_days",
    "is_late",
    "is_valid_sale",
)
CUSTOMER_COLUMNS = ("customer_unique_id", "customer_state", "customer_city")


def orders_with_customers(orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Orders with what all facts take from them and from their customer, the key included."""
    people = dim_customers.select("customer_id", "customer_key", *CUSTOMER_COLUMNS)
    columns = ["order_id", "customer_id", "order_status", PURCHASED, DELIVERED_AT, PROMISED_AT]
    return orders.select(*columns).join(people, "customer_id", "left")


def fact_orders(
    orders: DataFrame,
    customers: DataFrame | None,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    valid_only: bool = False,
) -> DataFrame:
    """One row per order.

    ``valid_only`` keeps valid sales: voided orders drop at the scan and orders
    without items in the join. ``customers=None`` leaves the customer columns out, and
    with them a shuffle by customer; orders that carry them are not joined. Summaries whose columns a report does not use
    are removed by the optimizer, since they are unique by ``order_id``.
    """
    if valid_only:
        orders = orders.filter(not_voided())
    if customers is not None and not {*CUSTOMER_COLUMNS} <= {*orders.columns}:
        people = customers.select("customer_id", *CUSTOMER_COLUMNS)
        orders = orders.join(people, "customer_id", "left")
    joined = (
        orders.join(
            order_item_summary(items), "order_id", "inner" if valid_only else "left"
        )
        .join(order_payment_summary(payments), "order_id", "left")
        .join(order_review_summary(reviews), "order_id", "left")
    )
    delivered = is_delivered()
    derived = joined.withColumns(
        {
            "purchase_date": F.to_date(PURCHASED),
            "purchase_month": month_start(PURCHASED),
            "is_delivered": _flag(delivered),
            "delivery_days": F.when(delivered, days_between(PURCHASED, DELIVERED_AT)),
            "delay_days": F.when(delivered, days_between(PROMISED_AT, DELIVERED_AT)),
            "is_late": _flag(is_late()),
            "is_valid_sale": _flag(F.col("item_count").isNotNull() & not_voided()),
        }
    )
    return derived.select(
        *[c for c in ORDER_COLUMNS if customers is not None or c not in CUSTOMER_COLUMNS]
    )


def fact_orders_together(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    hot: Sequence[str] = (),
) -> DataFrame:
    """``fact_orders`` for all orders: lines go to the task of their order and are folded there.

    Lines of an order seldom lie in one file, so folding them before the shuffle, as
    ``fact_orders`` does, takes a hash table of nearly all lines, which spills, and sends
    most of them twice: by order and seller, then by order. Only the lines of ``hot`` orders
    are folded first.
    """
    is_hot = F.coalesce(F.col("order_id").isin(*hot), F.lit(False))

    def gathered(lines: DataFrame, *columns: str) -> DataFrame:
        rows = lines.filter(~is_hot) if hot else lines
        return rows.select("order_id", *columns).repartition("order_id")

    together = fact_orders(
        orders.filter(~is_hot) if hot else orders,
        customers,
        gathered(items, "seller_id", "price", "freight_value"),
        gathered(payments, "payment_type", "payment_installments", "payment_value"),
        reviews,
    )
    if not hot:
        return together
    lines = [table.filter(is_hot) for table in (items, payments, reviews)]
    return together.unionByName(fact_orders(orders.filter(is_hot), customers, *lines))


# -- line grain ----------------------------------------------------------------------


def _order_header(
    orders: DataFrame, customer_keys: DataFrame, calendar: DataFrame, *columns: str
) -> DataFrame:
    """Order attributes of the line facts: customer key, date key and ``columns``.

    Orders that carry the key, as ``orders_with_customers`` gives them, are not joined.
    """
    if "customer_key" not in orders.columns:
        orders = orders.join(customer_keys, "customer_id", "left")
    days = calendar.select(
        F.col("calendar_date").alias("_day"), F.col("date_key").alias("purchase_date_key")
    )
    return (
        orders.withColumn("_day", F.to_date(PURCHASED))
        # Bounded: one row per day of the calendar.
        .join(F.broadcast(days), "_day", "left")
        .select("order_id", "customer_key", "purchase_date_key", *columns)
    )


def fact_order_items(
    items: DataFrame,
    orders: DataFrame,
    customer_keys: DataFrame,
    product_keys: DataFrame,
    seller_keys: DataFrame,
    calendar: DataFrame,
    hot_products: Sequence[str] | None = None,
) -> DataFrame:
    header = _order_header(
        orders, customer_keys, calendar, "order_status", PURCHASED, DELIVERED_AT, PROMISED_AT
    )
    line = ["order_id", "order_item_id", "price"]
    # Sellers first: they are few, and a lookup that shuffles sends their key, not their id.
    keyed = lookup_join(items, seller_keys, "seller_id", "left", line).drop("seller_id")
    keyed = lookup_join(keyed, product_keys, "product_id", "left", line, hot=hot_products)
    return keyed.join(header, "order_id").select(
        "order_id",
        "order_item_id",
        "customer_key",
        "product_key",
        "seller_key",
        "purchase_date_key",
        "order_status",
        PURCHASED,
        DELIVERED_AT,
        PROMISED_AT,
        "price",
        "freight_value",
        days_between(PURCHASED, DELIVERED_AT).alias("delivery_days"),
        days_between(PROMISED_AT, DELIVERED_AT).alias("delivery_delay_days"),
    )


def fact_payments(
    payments: DataFrame, orders: DataFrame, customer_keys: DataFrame, calendar: DataFrame
) -> DataFrame:
    header = _order_header(orders, customer_keys, calendar, "order_status")
    return payments.join(header, "order_id").select(
        "order_id",
        "payment_sequential",
        "customer_key",
        "purchase_date_key",
        "order_status",
        "payment_type",
        "payment_installments",
        "payment_value",
    )


def fact_reviews(
    reviews: DataFrame, orders: DataFrame, customer_keys: DataFrame, calendar: DataFrame
) -> DataFrame:
    header = _order_header(orders, customer_keys, calendar, "order_status")
    return reviews.join(header, "order_id").select(
        "review_id",
        "order_id",
        "customer_key",
        "purchase_date_key",
        "order_status",
        "review_score",
        "review_creation_date",
        "review_answer_timestamp",
        days_between("review_creation_date", "review_answer_timestamp").alias(
            "review_response_days"
        ),
    )
