"""Payments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake import fixed_values as fv
from bazaarlake.functions import band, pct, ratio
from bazaarlake.operators.shares import pct_of_total
from bazaarlake.plans.questions.common import kept_orders, kept_status
from bazaarlake.plans.warehouse import Warehouse


def _payments(wh: Warehouse) -> DataFrame:
    """Payments; those of a loaded fact bring their order's status and are kept already."""
    fact = wh.loaded("fact_payments")
    return wh.silver("order_payments") if fact is None else fact.filter(kept_status())


def _of_kept_orders(wh: Warehouse, per_order: DataFrame) -> DataFrame:
    if wh.loaded("fact_payments") is not None:
        return per_order
    return per_order.join(kept_orders(wh), "order_id")


def payment_mix(wh: Warehouse) -> DataFrame:
    """Orders, value, average ticket and installments per payment type."""
    # Folded per order and type first: an order split into very many payments reaches
    # the join as a few rows.
    per_order = (
        _payments(wh)
        .groupBy("order_id", "payment_type")
        .agg(
            F.sum("payment_value").alias("value"),
            F.count("payment_value").alias("payments"),
            F.sum("payment_installments").alias("installments"),
            F.count("payment_installments").alias("installment_plans"),
        )
    )
    mix = (
        _of_kept_orders(wh, per_order)
        .groupBy("payment_type")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.sum("value").alias("total_value"),
            ratio(F.sum("value"), F.sum("payments"), 2).alias("avg_payment"),
            ratio(F.sum("installments"), F.sum("installment_plans"), 1).alias(
                "avg_installments"
            ),
        )
    )
    return pct_of_total(mix, "total_value", "value_share_pct", 1).orderBy(
        F.col("total_value").desc(), "payment_type"
    )


def installments_by_value(wh: Warehouse) -> DataFrame:
    """Use of installments per band of card payment value."""
    cards = _payments(wh).filter(F.col("payment_type") == fv.CREDIT_CARD)
    value_band = band(F.col("payment_value"), fv.PAYMENT_BAND_EDGES, fv.PAYMENT_BAND_LABELS)
    per_order = cards.groupBy("order_id", value_band.alias("value_band")).agg(
        F.count(F.lit(1)).alias("payments"),
        F.sum("payment_installments").alias("installments"),
        F.count("payment_installments").alias("installment_plans"),
        F.count_if(F.col("payment_installments") > 1).alias("split"),
    )
    return (
        _of_kept_orders(wh, per_order)
        .groupBy("value_band")
        .agg(
            F.sum("payments").alias("payments"),
            ratio(F.sum("installments"), F.sum("installment_plans"), 1).alias(
                "avg_installments"
            ),
            pct(F.sum("split"), F.sum("payments"), 1).alias("pct_using_installments"),
        )
        .orderBy("value_band")
    )
