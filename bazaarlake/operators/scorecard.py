"""Scorecards: groups with enough rows behind them, and their measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def scorecard(
    df: DataFrame,
    by: str,
    count: Column,
    min_count: int,
    measures: Sequence[Column],
    count_name: str = "orders",
) -> DataFrame:
    """One row per ``by`` with at least ``min_count`` of ``count``, and its ``measures``.

    ``count`` and the measures are aggregates; the measures bring their names.
    """
    scored = df.groupBy(by).agg(count.alias(count_name), *measures)
    return scored.filter(scored[count_name] >= min_count)
