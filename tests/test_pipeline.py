"""Loaded layers give the reports the derived ones give."""

from __future__ import annotations

import pytest

from bazaarlake.plans.pipeline import (
    load_bronze,
    load_gold,
    load_silver,
    register_tables,
    register_views,
)
from bazaarlake.plans.questions import QUESTIONS
from bazaarlake.plans.warehouse import GOLD_TABLES, Warehouse
from bazaarlake.sources.audit import BATCH, audit_frame
from bazaarlake.sources.schemas import SILVER
from bazaarlake.testbed.landing import landed_warehouse
from bazaarlake.testbed.registry import derived_warehouse


@pytest.fixture(scope="module")
def loaded(spark, sf_small):
    config = landed_warehouse(spark, sf_small)
    audit = load_bronze(spark, config) + load_silver(spark, config) + load_gold(spark, config)
    return config, audit


def plain(df):
    return sorted(map(repr, df.collect()))


def test_audit_covers_every_table(spark, loaded):
    _, audit = loaded
    frame = audit_frame(spark, audit)
    # A row per table, and one for each layer's batch.
    assert frame.count() == 9 + len(SILVER) + len(GOLD_TABLES) + 3
    assert {r["status"] for r in frame.collect()} == {"loaded"}
    assert all(load.rows_written > 0 for load in audit)


def test_a_second_load_replaces_the_first(spark, loaded):
    config, audit = loaded
    again = load_silver(spark, config)
    first = {a.table_name: a.rows_written for a in audit if a.layer == "silver"}
    assert {a.table_name: a.rows_written for a in again} == first
    assert first.pop(BATCH) == sum(first.values())
    for name, rows in first.items():
        assert Warehouse.from_tables(spark, config).silver(name).count() == rows


@pytest.mark.parametrize("name", ["fact_orders", "fact_order_items", "dim_sellers", "dim_date"])
def test_written_star_equals_derived_star(spark, loaded, sf_small, name):
    config, _ = loaded
    written = Warehouse.from_tables(spark, config, gold=GOLD_TABLES).gold(name)
    assert plain(written) == plain(derived_warehouse(spark, sf_small).gold(name))


@pytest.mark.parametrize(
    "name",
    ["q01_monthly_sales_growth", "q04a_weekday_profile", "q07_category_scorecard",
     "q12_review_by_delay", "q15_route_type", "q18_seller_scorecard", "q23_rfm_segments",
     "q24_cohort_retention", "q27_multi_seller", "q28_review_distribution"],
)
def test_reports_over_written_star(spark, loaded, sf_small, name):
    config, _ = loaded
    over_star = QUESTIONS[name](Warehouse.from_tables(spark, config, gold=GOLD_TABLES))
    assert plain(over_star) == plain(QUESTIONS[name](derived_warehouse(spark, sf_small)))


def test_sql_over_registered_tables_and_views(spark, loaded):
    config, _ = loaded
    register_tables(spark, config)
    tables = spark.sql("SELECT count(*) n, sum(is_valid_sale) s FROM gold.fact_orders").first()
    items = spark.sql(
        "SELECT count(*) n FROM gold.fact_order_items f"
        " JOIN gold.dim_products p ON p.product_key = f.product_key"
    ).first()
    assert items["n"] == spark.sql("SELECT count(*) n FROM silver.order_items").first()["n"]
    assert spark.sql("SELECT count(*) n FROM bronze.orders").first()["n"] == tables["n"]
    register_views(Warehouse.from_tables(spark, config))
    views = spark.sql("SELECT count(*) n, sum(is_valid_sale) s FROM gold_fact_orders").first()
    assert tables == views


def test_month_window_prunes_the_written_orders(spark, loaded):
    config, _ = loaded
    wh = Warehouse.from_tables(spark, config, gold=GOLD_TABLES)
    plan = QUESTIONS["q14_late_trend"](wh)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_purchase_timestamp" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the months
