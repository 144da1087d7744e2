"""Shares of a total. Inputs are finished group-level results, not row-level data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.functions import pct


def pct_of_total(groups: DataFrame, measure: str, out: str, places: int) -> DataFrame:
    whole = F.sum(measure).over(Window.partitionBy())
    return groups.withColumn(out, pct(F.col(measure), whole, places))


def pareto(
    groups: DataFrame,
    measure: str,
    tie_keys: Sequence[str],
    places: int = 2,
    cutoff_pct: float | None = None,
) -> DataFrame:
    """Add ``share_pct`` and ``cumulative_pct``, largest first.

    With ``cutoff_pct`` only the leading groups stay, up to and including the one
    that reaches the cut-off.
    """
    whole = F.sum(measure).over(Window.partitionBy())
    largest_first = [F.col(measure).desc(), *[F.col(k).asc() for k in tie_keys]]
    so_far = F.sum(measure).over(
        Window.orderBy(*largest_first).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
    )
    result = groups.select(
        "*",
        pct(F.col(measure), whole, places).alias("share_pct"),
        pct(so_far, whole, places).alias("cumulative_pct"),
        (so_far - F.col(measure)).alias("_before"),
        whole.alias("_whole"),
    )
    if cutoff_pct is not None:
        result = result.filter(
            F.col("_before") * 100 < F.col("_whole") * F.lit(cutoff_pct)
        )
    return result.drop("_before", "_whole").orderBy(*largest_first)


def share_full_outer(
    demand: DataFrame, supply: DataFrame, key: str, measures: tuple[str, str]
) -> DataFrame:
    """Full join of two group-level counts, each with its share of its own total.

    A missing side keeps its count NULL and takes share 0.
    """
    demand_n, supply_n = measures
    joined = demand.join(supply, key, "full_outer")
    everything = Window.partitionBy()

    def share(measure: str):
        return pct(
            F.coalesce(F.col(measure), F.lit(0)), F.sum(measure).over(everything), 1
        )

    return joined.select(
        key,
        supply_n,
        demand_n,
        share(demand_n).alias("demand_share_pct"),
        share(supply_n).alias("supply_share_pct"),
    )
