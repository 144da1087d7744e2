"""Every query by name, over the retail tables derived from a test data folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from bazaarlake.config import ReportParams
from bazaarlake.operators import rollups
from bazaarlake.plans import quality
from bazaarlake.plans.calendar import calendar_covering
from bazaarlake.plans.questions import QUESTIONS
from bazaarlake.plans.warehouse import GOLD_TABLES, Warehouse
from bazaarlake.sources.csv_files import SOURCES
from bazaarlake.sources.schemas import SILVER
from bazaarlake.testbed.compare import comparable
from bazaarlake.testbed.fixture import PARAMS, raw_tables
from bazaarlake.testbed.landing import (
    landed_audit,
    landed_rejects,
    landed_source,
    loaded_warehouse,
)

Query = Callable[[SparkSession, str], DataFrame]


def derived_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(spark, raw_tables(spark, sf_dir), PARAMS)


def _over_warehouse(build: Callable[[Warehouse], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(derived_warehouse(spark, sf_dir)))

    return query


_WAREHOUSE_QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {
    **{f"silver_{name}": (lambda wh, name=name: wh.silver(name)) for name in SILVER},
    **{
        f"gold_{name}": (lambda wh, name=name: wh.gold(name))
        for name in GOLD_TABLES
        if name != "dim_date"
    },
    "gold_dim_date": lambda wh: calendar_covering(wh.silver("orders")),
    "order_item_summary": lambda wh: rollups.order_item_summary(wh.silver("order_items")),
    "order_payment_summary": lambda wh: rollups.order_payment_summary(
        wh.silver("order_payments")
    ),
    "order_review_summary": lambda wh: rollups.order_review_summary(
        wh.silver("order_reviews")
    ),
    "check_fact_orders_grain": quality.fact_orders_grain,
    "check_grains": quality.grain_report,
    "dq_missing_category": quality.missing_category,
    "dq_untranslated_categories": quality.untranslated_category_names,
    "dq_missing_geolocation": quality.missing_geolocation,
    "dq_delivered_without_date": quality.delivered_without_date,
    "dq_undefined_payments": quality.undefined_payments,
    "dq_zero_weight": quality.zero_weight,
    "dq_duplicate_geolocation": quality.duplicate_geolocation,
    "quality_report": quality.quality_report,
    **QUESTIONS,
}


def _landed(name: str) -> Query:
    return lambda spark, sf_dir: comparable(landed_source(spark, sf_dir, name))


# Reports and facts read from the loaded layers, and what each must equal.
LOADED: dict[str, str] = {
    "loaded_q06": "q06_category_pareto",
    "loaded_q17": "q17_category_freight_burden",
    "loaded_q18": "q18_seller_scorecard",
    "loaded_q19": "q19_seller_deciles",
    "loaded_q25": "q25_payment_mix",
    "loaded_q26": "q26_installments_by_value",
    "loaded_q28": "q28_review_distribution",
    **{f"loaded_{name}": f"gold_{name}" for name in GOLD_TABLES if name.startswith("fact_")},
}


def _loaded(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        config = loaded_warehouse(spark, sf_dir)
        wh = Warehouse.from_tables(spark, config, gold=GOLD_TABLES)
        return comparable(_WAREHOUSE_QUERIES[LOADED[name]](wh))

    return query


# Reports with a switch turned: the report, and the parameters it gets.
SWITCHED: dict[str, tuple[str, ReportParams]] = {
    "q06_pareto_cutoff": (
        "q06_category_pareto",
        replace(PARAMS, pareto_cutoff_pct=50.0),
    ),
    "q23_recency_desc": ("q23_rfm_segments", replace(PARAMS, recency_desc=True)),
    # A calendar that ends before the data does.
    "dq_outside_calendar": ("outside_calendar", replace(PARAMS, calendar_to=date(1998, 1, 31))),
}


def _switched(name: str) -> Query:
    build, params = SWITCHED[name]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(_REPORTS[build](Warehouse(spark, raw_tables(spark, sf_dir), params)))

    return query


_REPORTS = {**_WAREHOUSE_QUERIES, "outside_calendar": quality.outside_calendar}

REGISTRY: dict[str, Query] = {
    **{name: _switched(name) for name in SWITCHED},
    **{name: _loaded(name) for name in LOADED},
    **{f"bronze_{name}": _landed(name) for name in SOURCES},
    "bronze_rejects": landed_rejects,
    "load_audit": landed_audit,
    **{name: _over_warehouse(build) for name, build in _WAREHOUSE_QUERIES.items()},
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return REGISTRY["q18_seller_scorecard"](spark, sf_dir)
