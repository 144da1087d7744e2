"""What a load writes and shuffles: files that stay small, orders joined to customers once."""

from __future__ import annotations

import pytest

from bazaarlake.plans.questions import QUESTIONS
from bazaarlake.plans.warehouse import DIMENSIONS, FACTS, Warehouse
from bazaarlake.sources.csv_files import SOURCES, accepted, read_raw
from bazaarlake.sources.tables import replace_table
from bazaarlake.testbed import landing
from bazaarlake.testbed.fixture import raw_tables
from bazaarlake.testbed.registry import derived_warehouse


def plain(df):
    return sorted(map(repr, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["order_items", "order_reviews"])
def test_landed_files_are_compressed_and_bounded(spark, sf_small, tmp_path, monkeypatch, name):
    monkeypatch.setattr(landing, "RECORDS_PER_FILE", 50)
    landing.land(spark, sf_small, name, str(tmp_path / name))
    assert not list((tmp_path / name).glob("*.csv"))
    rows = raw_tables(spark, sf_small)(name)
    assert len(list((tmp_path / name).glob("*.csv.gz"))) >= rows.count() / 50
    landed = accepted(read_raw(spark, SOURCES[name], str(tmp_path / name), raw_quotes=True))
    ids = ["order_id", "order_item_id" if name == "order_items" else "review_id"]
    assert plain(landed.select(*ids)) == plain(rows.select(*ids))


def test_tables_are_written_with_zstd(spark, tmp_path):
    replace_table(spark.range(10), str(tmp_path / "t"))
    assert list((tmp_path / "t").glob("*.zstd.parquet"))


@pytest.fixture(scope="module")
def shared(spark, sf_small):
    derived = derived_warehouse(spark, sf_small)
    gold = {name: derived.gold(name) for name in DIMENSIONS}
    wh = Warehouse(spark, derived.raw, derived.params, derived.silver, gold)
    wh.share_orders()
    return wh


@pytest.mark.parametrize("name", FACTS)
def test_facts_over_shared_orders(spark, sf_small, shared, name):
    assert plain(shared.gold(name)) == plain(derived_warehouse(spark, sf_small).gold(name))


def test_facts_join_no_customers_again(shared):
    joins = {name: plan_of(shared.gold(name)).count("Join") for name in FACTS}
    # fact_payments and fact_reviews: calendar and orders; fact_orders: the three summaries.
    assert (joins["fact_payments"], joins["fact_reviews"], joins["fact_orders"]) == (2, 2, 3)


def test_pareto_of_the_loaded_fact_counts_orders_once(spark, sf_small, shared):
    derived = derived_warehouse(spark, sf_small)
    gold = {"fact_order_items": derived.gold("fact_order_items"), **shared._gold}
    loaded = Warehouse(spark, derived.raw, derived.params, derived.silver, gold)
    pareto = QUESTIONS["q06_category_pareto"]
    assert "distinct" not in plan_of(pareto(loaded))
    assert plain(pareto(loaded)) == plain(pareto(derived))
