"""Checks that return their finding as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grain_check(df: DataFrame, keys: Sequence[str], rows: str, distinct: str) -> DataFrame:
    """One row: how many rows, and how many different keys.

    Keys are folded with their counts first, so no task sees all copies of a key.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    whole_key = F.lit(True)
    for key in keys:
        whole_key = whole_key & F.col(key).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias(rows),
        F.count_if(whole_key).alias(distinct),
    )


def rule(df: DataFrame, table: str, name: str, failing: Column) -> DataFrame:
    """One row: how many rows of ``df`` break a rule, out of how many."""
    return df.agg(
        F.count_if(failing).alias("failing_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    ).select(
        F.lit(table).alias("table_name"),
        F.lit(name).alias("rule_name"),
        "failing_rows",
        "total_rows",
    )
