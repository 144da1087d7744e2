"""Top-k reports: rows cut by an explicit, total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(
    df: DataFrame, k: int, sort: Sequence[Column], tie_keys: Sequence[str]
) -> DataFrame:
    """First ``k`` rows; plans as a per-task top-k followed by one merge of k rows each."""
    return df.orderBy(*sort, *[F.col(t).asc() for t in tie_keys]).limit(k)


def ranked_top_k(
    df: DataFrame, k: int, measure: str, tie_keys: Sequence[str], rank: str
) -> DataFrame:
    """Top ``k`` rows by ``measure`` with their RANK (gaps on ties).

    A rank depends on larger values only, and all of those are inside the cut, so
    the window runs over the k rows left.
    """
    largest_first = F.col(measure).desc()
    return top_k(df, k, [largest_first], tie_keys).withColumn(
        rank, F.rank().over(Window.orderBy(largest_first))
    )
