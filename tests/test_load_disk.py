"""What a load leaves on disk, and lines that are shuffled once by their order."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from bazaarlake import session
from bazaarlake.operators import hot_keys
from bazaarlake.operators.lookup import lookup_join
from bazaarlake.plans import pipeline, warehouse
from bazaarlake.plans.pipeline import load_bronze, load_gold, load_silver
from bazaarlake.plans.questions import QUESTIONS
from bazaarlake.plans.warehouse import DIMENSIONS, FACTS, GOLD_TABLES, Warehouse
from bazaarlake.sources.schemas import SILVER
from bazaarlake.sources.tables import replace_table
from bazaarlake.testbed.landing import landed_warehouse
from bazaarlake.testbed.registry import derived_warehouse


def plain(df):
    return sorted(map(repr, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def shuffles_by(df, *columns):
    keys = ", ".join(rf"{c}#\d+L?" for c in columns)
    return len(re.findall(rf"Exchange hashpartitioning\({keys}, \d+\)", plan_of(df)))


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return {files.apply(i).getName() for i in range(files.size())}


def intermediate(spark):
    files = spark._jvm.java.io.File(session.scratch_root(spark)).list() or []
    return {f for f in files if f.startswith(("rank-", "orders-with-"))}


# -- hot keys --------------------------------------------------------------------------


@pytest.fixture
def rows(spark):
    other = (F.col("id") % 40).cast("string")
    key = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 7 != 0, other)
    return spark.range(2000).select("id", key.alias("k"), (F.col("id") % 9).alias("g"))


def test_hot_keys_are_found_and_null_is_none(rows):
    assert hot_keys.hot_keys(rows, "k", 500) == ["hot"]
    assert hot_keys.hot_keys(rows, "k") == []
    assert hot_keys.hot_keys(rows.limit(0), "k", 1) == []


@pytest.mark.parametrize("hot", [(), ("hot",)])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_only_hot_keys_of_a_lookup_are_repeated(spark, conf, rows, how, hot):
    lookup = rows.select("k").distinct().filter("k IS NULL OR k <> '9'").withColumn("v", F.hash("k"))
    expected = plain(rows.join(lookup, "k", how).select("id", "k", "v"))
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    joined = lookup_join(rows, lookup, "k", how, ["id"], hot=hot)
    assert plain(joined.select("id", "k", "v")) == expected
    # The value is asked for, as a join nobody reads would be left out.
    placed = joined.select("k", "v", F.spark_partition_id().alias("p")).distinct()
    spread = {r["k"]: r["count"] for r in placed.groupBy("k").count().collect()}
    assert (spread.pop("hot") >= 6) == bool(hot)
    assert set(spread.values()) == {1}


def test_folded_per_key_with_hot_and_null_keys(conf, rows):
    facts = rows.select("k").distinct().filter("k IS NULL OR k <> '9'").withColumn("f", F.hash("k"))
    facts = facts.unionByName(facts.filter("k = '3'"))  # facts may repeat
    folds = [F.count(F.lit(1)).alias("n"), F.sum("f").alias("s")]
    expected = plain(rows.join(facts, "k").groupBy("k", "g").agg(*folds))
    conf(autoBroadcastJoinThreshold="-1")
    for keys in ([], ["hot"], ["hot", "1", "3"]):
        hot = facts.filter(F.col("k").isin(keys)).select("k")
        assert plain(hot_keys.folded_per_key(rows, "k", "g", facts, hot, *folds)) == expected


# -- facts of a load -------------------------------------------------------------------


@pytest.fixture(scope="module")
def hot_silver(spark, sf_small, tmp_path_factory):
    """Cleansed tables; one order has a third of all items and payments, one product too."""
    root = tmp_path_factory.mktemp("silver")
    derived = derived_warehouse(spark, sf_small)
    for name in SILVER:
        df = derived.silver(name)
        third = F.hash(*df.columns) % 3 == 0
        if name in ("order_items", "order_payments"):
            df = df.withColumn("order_id", F.when(third, "o5").otherwise(F.col("order_id")))
        if name == "order_items":
            product = F.when(F.hash("price") % 3 == 0, "p7").otherwise(F.col("product_id"))
            df = df.withColumn("product_id", product)
        if name == "orders":
            df = df.unionByName(df.limit(1).withColumn("order_id", F.lit(None).cast("string")))
        df.write.parquet(str(root / name))
    return lambda name: spark.read.schema(SILVER[name]).parquet(str(root / name))


def warehouses(spark, sf_small, silver):
    derived = derived_warehouse(spark, sf_small)
    over = Warehouse(spark, derived.raw, derived.params, silver)
    gold = {name: over.gold(name) for name in DIMENSIONS}
    shared = Warehouse(spark, derived.raw, derived.params, silver, gold)
    shared.share_orders()
    return over, shared


def test_facts_of_a_load_with_hot_orders_and_products(spark, sf_small, hot_silver, conf, monkeypatch):
    monkeypatch.setattr(hot_keys, "HOT_ROWS", 400)
    conf(autoBroadcastJoinThreshold="-1")
    over, shared = warehouses(spark, sf_small, hot_silver)
    assert (shared._hot_orders, shared._hot_products) == (["o5"], ["p7"])
    for name in FACTS:
        assert plain(shared.gold(name)) == plain(over.gold(name))
    # Lines of the hot order are folded before they are sent, in the second part of the union.
    assert shuffles_by(shared.gold("fact_orders"), "order_id", "seller_id") == 1


def test_a_load_sends_lines_once_by_their_order(spark, sf_small, conf):
    conf(autoBroadcastJoinThreshold="-1")
    derived = derived_warehouse(spark, sf_small)
    _, shared = warehouses(spark, sf_small, derived.silver)
    orders = shared.gold("fact_orders")
    assert shuffles_by(orders, "order_id", "seller_id") == 0
    assert shuffles_by(orders, "order_id", "payment_type") == 0
    assert shuffles_by(orders, "order_id") == 4  # orders, items, payments, reviews
    # No order and no product has many lines here, so no lookup is repeated.
    assert "_salt" not in plan_of(shared.gold("fact_order_items")).split("seller_id")[0]


@pytest.mark.parametrize("name", ["q18_seller_scorecard", "q20_sellers_at_risk"])
@pytest.mark.parametrize("hot_rows", [1, 400, 100_000])
def test_sellers_over_loaded_facts_send_lines_once(
    spark, sf_small, hot_silver, conf, monkeypatch, name, hot_rows
):
    monkeypatch.setattr(warehouse, "HOT_ROWS", hot_rows)
    conf(autoBroadcastJoinThreshold="-1")
    over, _ = warehouses(spark, sf_small, hot_silver)
    gold = {table: over.gold(table) for table in GOLD_TABLES}
    loaded = Warehouse(spark, over.raw, over.params, hot_silver, gold)
    report = QUESTIONS[name](loaded)
    assert plain(report) == plain(QUESTIONS[name](over))
    # Neither by order and seller before the join nor for a count of orders after it.
    assert shuffles_by(report, "order_id", "seller_id") == 0
    assert shuffles_by(report, "order_id", "_part") == 2  # lines, outcomes
    assert shuffles_by(report, "seller_id", "order_id") == 0


def test_sellers_over_loaded_facts_where_orders_repeat(spark, sf_small):
    derived = derived_warehouse(spark, sf_small)

    def silver(name):
        df = derived.silver(name)
        return df.unionByName(df.filter("hash(order_id) % 3 = 0")) if name == "orders" else df

    over, _ = warehouses(spark, sf_small, silver)
    gold = {table: over.gold(table) for table in GOLD_TABLES}
    # The line facts repeat the lines of a repeated order; the report over them must not again.
    gold["fact_order_items"] = derived.gold("fact_order_items")
    loaded = Warehouse(spark, over.raw, over.params, silver, gold)
    for name in ("q18_seller_scorecard", "q20_sellers_at_risk"):
        assert plain(QUESTIONS[name](loaded)) == plain(QUESTIONS[name](over))


# -- what is left on disk --------------------------------------------------------------


def test_shuffles_are_deleted_when_their_query_ends(spark, tmp_path):
    def table(name):
        replace_table(spark.range(1000).repartition(4, "id"), str(tmp_path / name))

    before = shuffle_files(spark)
    with session.shuffles_dropped(spark):
        table("a")
    assert not {f for f in shuffle_files(spark) - before if f.startswith("shuffle_")}
    table("b")
    assert {f for f in shuffle_files(spark) - before if f.startswith("shuffle_")}


def test_written_tables_are_deleted_by_what_reads_them(spark):
    one, two = (session.written(spark.range(n), f"range-{n}") for n in (3, 4))
    joined = one.join(two, "id")
    both = one.unionByName(two)
    other = session.written(joined, "joined")
    session.drop_written(both.filter("id > 1"))
    assert other.count() == 3
    scratch = spark._jvm.java.io.File(session.scratch_root(spark)).list()
    assert not [f for f in scratch if f.startswith("range-")]


def test_a_load_leaves_no_intermediate_tables_and_no_shuffles(spark, sf_small, monkeypatch):
    large, together = [], []

    def watched(df, path, check):
        name = path.rsplit("/", 1)[-1]
        if name in ("fact_order_items", "fact_orders"):
            large.append(name)
            together.append(len(large))
        replace_table(df, path, check)
        if name in large:
            large.remove(name)

    monkeypatch.setattr(pipeline, "replace_table", watched)
    tables, files = intermediate(spark), shuffle_files(spark)
    config = landed_warehouse(spark, sf_small)
    load_bronze(spark, config), load_silver(spark, config), load_gold(spark, config)
    assert intermediate(spark) - tables == set()
    assert not {f for f in shuffle_files(spark) - files if f.startswith("shuffle_")}
    assert together == [1, 1]  # the two facts that shuffle most take turns
    loaded = Warehouse.from_tables(spark, config, gold=GOLD_TABLES)
    assert loaded.gold("fact_orders").count() == loaded.silver("orders").count()
