"""Customer segmentation and cohort retention on order-level facts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake import fixed_values as fv
from bazaarlake.functions import days_between, months_between_starts, pct
from bazaarlake.operators.ranking import global_ntile


def rfm_scores(
    sales: DataFrame, ref_date: Column, recency_desc: bool = False
) -> DataFrame:
    """Recency, frequency and monetary value per person, with quintile scores."""
    people = sales.groupBy("customer_unique_id").agg(
        F.max("purchase_date").alias("last_purchase"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("items_value").alias("monetary"),
    )
    people = people.select(
        "customer_unique_id",
        days_between(F.col("last_purchase"), ref_date).alias("recency_days"),
        "frequency",
        "monetary",
    )
    recency = F.col("recency_days").desc() if recency_desc else F.col("recency_days").asc()
    person = F.col("customer_unique_id").asc()
    scored = global_ntile(people, fv.RFM_TILES, "r_score", [recency, person])
    return global_ntile(scored, fv.RFM_TILES, "m_score", [F.col("monetary").asc(), person])


def rfm_segment() -> Column:
    """Segment of a scored person; the first rule that holds wins."""
    repeat = F.col("frequency") >= 2
    return (
        F.when(repeat & (F.col("r_score") >= 3), fv.LOYAL)
        .when(repeat, fv.LAPSING)
        .when((F.col("m_score") == 5) & (F.col("r_score") >= 4), fv.HIGH_VALUE_NEW)
        .when(F.col("r_score") <= 2, fv.ONE_TIME_LAPSED)
        .otherwise(fv.ONE_TIME_RECENT)
    )


def cohort_retention(
    sales: DataFrame, max_months: int, cohorts_from: date, cohorts_to: date
) -> DataFrame:
    """Share of each first-purchase cohort that buys again n months later."""
    # One row per person and active month. A busy person is folded on the map side,
    # and the window group below is at most one row per month of the calendar.
    active = (
        sales.filter(F.col("customer_unique_id").isNotNull())
        .select("customer_unique_id", "purchase_month")
        .distinct()
    )
    cohort = F.min("purchase_month").over(Window.partitionBy("customer_unique_id"))
    counts = (
        active.withColumn("cohort_month", cohort)
        .withColumn(
            "months_since",
            months_between_starts(F.col("cohort_month"), F.col("purchase_month")),
        )
        .filter(
            (F.col("months_since") <= max_months)
            & F.col("cohort_month").between(F.lit(cohorts_from), F.lit(cohorts_to))
        )
        .groupBy("cohort_month", "months_since")
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    at_start = F.first("active_customers").over(
        Window.partitionBy("cohort_month").orderBy("months_since")
    )
    return counts.withColumn(
        "retention_pct", pct(F.col("active_customers"), at_start, 2)
    ).orderBy("cohort_month", "months_since")
