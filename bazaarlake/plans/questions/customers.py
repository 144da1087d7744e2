"""Customers and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions import mean_of, pct
from bazaarlake.operators.segments import cohort_retention, rfm_scores, rfm_segment
from bazaarlake.operators.shares import pct_of_total
from bazaarlake.plans.warehouse import Warehouse


def repeat_rate(wh: Warehouse) -> DataFrame:
    """Share of persons with more than one valid order, in one row."""
    people = (
        wh.fact_orders(valid_only=True)
        .groupBy("customer_unique_id")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    repeat = F.count_if(F.col("orders") > 1)
    return people.agg(
        F.count(F.lit(1)).alias("customers"),
        repeat.alias("repeat_customers"),
        pct(repeat, F.count(F.lit(1)), 2).alias("repeat_pct"),
    )


def rfm_segments(wh: Warehouse) -> DataFrame:
    """Persons by recency, frequency and spend, in named segments.

    Recency counts back from the last purchase of any order, valid or not.
    """
    last_day = (
        wh.silver("orders")
        .agg(F.to_date(F.max("order_purchase_timestamp")).alias("last_day"))
        .scalar()
    )
    scored = rfm_scores(wh.fact_orders(valid_only=True), last_day, wh.params.recency_desc)
    segments = scored.groupBy(rfm_segment().alias("segment")).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("monetary").alias("revenue"),
        mean_of("monetary", 2).alias("avg_spend"),
    )
    return pct_of_total(segments, "customers", "pct_of_customers", 1).orderBy(
        F.col("customers").desc(), "segment"
    )


def retention(wh: Warehouse) -> DataFrame:
    """Share of each monthly cohort that is active n months later."""
    p = wh.params
    return cohort_retention(
        wh.fact_orders(valid_only=True), p.cohort_months, p.cohorts_from, p.cohorts_to
    )
