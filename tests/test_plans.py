"""What the physical plans may and may not hold."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from bazaarlake.plans.questions import QUESTIONS
from bazaarlake.plans.warehouse import GOLD_TABLES, Warehouse
from bazaarlake.sources.schemas import SILVER
from bazaarlake.testbed.registry import derived_warehouse


@pytest.fixture(scope="module")
def tables(spark, sf_small, tmp_path_factory):
    """Cleansed tables as files; one order holds a third of all items and payments."""
    root = tmp_path_factory.mktemp("silver")
    derived = derived_warehouse(spark, sf_small)
    for name in SILVER:
        df = derived.silver(name)
        if name in ("order_items", "order_payments"):
            key = F.when(F.hash(*df.columns) % 3 == 0, "o5").otherwise(F.col("order_id"))
            df = df.withColumn("order_id", key)
        df.repartition(8).write.parquet(str(root / name))  # several map tasks to split by
    return root


@pytest.fixture
def wh(spark, tables, sf_small):
    def silver(name):
        return spark.read.schema(SILVER[name]).parquet(str(tables / name))

    derived = derived_warehouse(spark, sf_small)
    return Warehouse(spark, derived.raw, derived.params, silver)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plan_of(df):
    """The plan before it runs."""
    text = executed(df)
    return text.split("== Initial Plan ==")[-1]


def single_partition_inputs(plan):
    """The operators right below each exchange into one partition."""
    lines = plan.splitlines()
    return [
        re.sub(r"^[\s:+\-*()0-9]*", "", lines[i + 1]).split(" ")[0].split("(")[0]
        for i, line in enumerate(lines)
        if "Exchange SinglePartition" in line
    ]


@pytest.mark.parametrize("name", sorted(QUESTIONS))
def test_no_cross_join_no_python_and_no_rows_into_one_task(wh, name):
    plan = plan_of(QUESTIONS[name](wh))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "UDF"):
        assert bad not in plan
    # Only finished groups reach a single task: aggregates, windows over them, top-k.
    allowed = {"HashAggregate", "SortAggregate", "ObjectHashAggregate", "Project", "Filter"}
    assert set(single_partition_inputs(plan)) <= allowed
    assert "Window" not in single_partition_inputs(plan)


@pytest.mark.parametrize("name", ["dim_customers", "dim_products", "dim_sellers"])
def test_surrogate_keys_do_not_use_a_global_window(wh, name):
    plan = plan_of(wh.gold(name))
    # The only single partition holds one row per range: the offsets.
    assert set(single_partition_inputs(plan)) <= {"HashAggregate"}
    assert "row_number" not in plan


def test_unused_summaries_and_columns_are_pruned(wh):
    plan = plan_of(QUESTIONS["q10_delivery_kpis"](wh))
    assert "Join" not in plan
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert len(schema) == 1 and "order_approved_at" not in schema[0]

    plan = plan_of(QUESTIONS["q01_monthly_sales_growth"](wh))
    assert "payment_value" not in plan and "review_score" not in plan
    assert "seller_id" not in plan  # the distinct count of sellers goes with it


def test_filters_reach_the_scan(wh):
    plan = plan_of(QUESTIONS["q01_monthly_sales_growth"](wh))
    assert "PushedFilters: [IsNotNull(order_purchase_timestamp)" in plan
    assert "GreaterThanOrEqual(order_purchase_timestamp" in plan
    plan = plan_of(QUESTIONS["q26_installments_by_value"](wh))
    assert "EqualTo(payment_type,credit_card)" in plan


def run_skewed(conf, df):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="512b",
        adaptive__coalescePartitions__enabled="false",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="1k",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )
    return df()


@pytest.mark.parametrize(
    "name",
    ["q15_route_type", "q17_category_freight_burden", "q19_seller_deciles",
     "q26_installments_by_value", "q28_review_distribution"],
)
def test_lines_of_a_hot_order_are_folded_before_the_join(wh, conf, name):
    expected = [r.asDict() for r in QUESTIONS[name](wh).collect()]

    def run():
        return [r.asDict() for r in QUESTIONS[name](wh).collect()]

    assert run_skewed(conf, run) == expected
    if name != "q19_seller_deciles":  # its tiles are written on the way
        plan = plan_of(QUESTIONS[name](wh))
        # Before anything is shuffled by order alone, lines are partial sums per order.
        assert re.search(r"HashAggregate\(keys=\[order_id#\d+, [^]]*\], functions=\[partial_", plan)


def test_hot_order_is_split_in_the_item_fact(wh, conf):
    expected = wh.gold("fact_order_items").groupBy().count().first()[0]

    def run():
        df = wh.gold("fact_order_items")
        df.write.format("noop").mode("overwrite").save()
        rows = df.collect()
        return len(rows), executed(df)

    rows, plan = run_skewed(conf, run)
    assert rows == expected
    assert "skew=true" in plan or "isSkew" in plan


@pytest.mark.parametrize(
    "name",
    ["q06_category_pareto", "q08_lowest_rated_categories", "q18_seller_scorecard",
     "q25_payment_mix"],
)
def test_hot_order_is_folded_before_the_join(wh, name):
    """Items of one order reach the join as one row per category, seller or type."""
    plan = plan_of(QUESTIONS[name](wh))
    fact = "order_payments" if "payment" in name else "order_items"
    scan = plan.index(f"/{fact}]")
    below_join = plan[:scan].splitlines()
    joins = [i for i, line in enumerate(below_join) if "order_id" in line and "Join" in line]
    folds = [i for i, line in enumerate(below_join) if "HashAggregate(keys=[order_id" in line]
    assert joins and folds and folds[-1] > joins[0]


def test_all_star_tables_are_known(wh):
    with pytest.raises(KeyError):
        wh.gold("fact_unknown")
    assert set(GOLD_TABLES) == {
        "dim_customers", "dim_products", "dim_sellers", "dim_date",
        "fact_order_items", "fact_payments", "fact_reviews", "fact_orders",
    }
