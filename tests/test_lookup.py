from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bazaarlake.operators.lookup import lookup_join, lookup_with_fallback


@pytest.fixture
def rows(spark):
    # Half of the rows hold one key, some hold none, some an unknown one.
    key = (
        F.when(F.col("id") % 2 == 0, "hot")
        .when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 40))
    )
    return spark.range(2000).select("id", key.alias("k"))


@pytest.fixture
def lookup(spark):
    return spark.range(30).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
        (F.col("id") * 10).alias("v"),
    )


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(conf, rows, lookup, how):
    plain = rows.join(lookup, "k", how).select("id", "k", "v").collect()
    conf(autoBroadcastJoinThreshold="-1")
    salted = lookup_join(rows, lookup, "k", how).select("id", "k", "v")
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan and "BroadcastHashJoin" not in plan
    order = lambda r: r["id"]
    assert sorted(salted.collect(), key=order) == sorted(plain, key=order)


def test_hot_key_is_spread(conf, rows, lookup):
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    joined = lookup_join(rows, lookup, "k", "left", spread=["id"])
    hot = joined.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(hot) >= 6
    assert max(r["count"] for r in hot) < 500


def test_small_lookup_is_broadcast(rows, lookup):
    plan = lookup_join(rows, lookup, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "_salt" not in plan


def test_fallback_chain(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    names = spark.createDataFrame([("a", "A")], "key string, name string")
    got = lookup_with_fallback(
        df, names, F.col("k"), "key", "name", "out", [F.col("k"), F.lit("none")]
    )
    assert sorted(r["out"] for r in got.collect()) == ["A", "b", "none"]
