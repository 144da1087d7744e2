from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bazaarlake.operators.ranking import add_surrogate_key, global_ntile, global_row_number


def numbers(spark, n):
    # A third of the rows share one value; some values are NULL.
    value = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 != 0, F.hash("id") % 50)
    return spark.range(n).select(
        F.concat(F.lit("k"), F.col("id")).alias("k"), value.cast("long").alias("v")
    )


def orders_of(direction):
    value = F.col("v").desc() if direction == "desc" else F.col("v").asc()
    return [value, F.col("k").asc()]


@pytest.mark.parametrize("n", [0, 1, 5, 1000])
@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_row_number_equals_the_window(spark, n, direction):
    order = orders_of(direction)
    ranked = global_row_number(numbers(spark, n), "rn", order)
    expected = numbers(spark, n).withColumn("rn", F.row_number().over(Window.orderBy(*order)))
    assert sorted(ranked.select("k", "rn").collect()) == sorted(
        expected.select("k", "rn").collect()
    )


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_row_number_over_several_ranges(spark, conf, adaptive):
    conf(adaptive__enabled=adaptive, adaptive__coalescePartitions__minPartitionSize="1b")
    ranked = global_row_number(numbers(spark, 5000), "rn", ["v", "k"])
    window = F.row_number().over(Window.orderBy("v", "k"))
    expected = numbers(spark, 5000).withColumn("rn", window)
    assert len(ranked.inputFiles()) > 1
    assert sorted(ranked.select("k", "rn").collect()) == sorted(
        expected.select("k", "rn").collect()
    )


@pytest.mark.parametrize("n,tiles", [(0, 5), (3, 5), (5, 5), (1000, 7), (1001, 10)])
@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_ntile_equals_the_window(spark, n, tiles, direction):
    order = orders_of(direction)
    tiled = global_ntile(numbers(spark, n), tiles, "t", order)
    expected = numbers(spark, n).withColumn("t", F.ntile(tiles).over(Window.orderBy(*order)))
    assert sorted(tiled.select("k", "t").collect()) == sorted(
        expected.select("k", "t").collect()
    )


def test_surrogate_key_is_dense_and_ordered(spark):
    keyed = add_surrogate_key(numbers(spark, 100), "key", "k")
    assert keyed.columns[0] == "key"
    rows = keyed.orderBy("key").collect()
    assert [r["key"] for r in rows] == list(range(1, 101))
    assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)


def test_a_run_of_equal_values_is_split_over_tasks(spark):
    one_value = spark.range(8000).select(
        F.lit(1).alias("v"), F.format_string("%05d", "id").alias("k")
    )
    order = ["v", "k"]
    parts = (
        one_value.repartitionByRange(8, *order)
        .groupBy(F.spark_partition_id()).count().collect()
    )
    assert len(parts) == 8
    assert max(p["count"] for p in parts) < 2000
