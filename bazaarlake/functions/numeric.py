"""Ratios, averages and percentages with one rounding rule.

Numerator and denominator are exact sums (integer or decimal). They are divided as
doubles, fixed to eight decimals and only then rounded half up, so that a result
never depends on the order in which partial sums were merged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, places: int) -> Column:
    """A double fixed to eight decimals, then rounded half up."""
    return F.round(value.cast("decimal(18,8)"), places).cast("double")


def ratio(num: Column, den: Column, places: int) -> Column:
    """``num / den`` rounded; NULL when the denominator is zero or NULL."""
    quotient = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return rounded(quotient, places)


def pct(num: Column, den: Column, places: int) -> Column:
    return ratio(num.cast("double") * F.lit(100.0), den, places)


def mean_of(c: str | Column, places: int) -> Column:
    """Aggregate: average of the non-NULL values."""
    c = F.col(c) if isinstance(c, str) else c
    return ratio(F.sum(c), F.count(c), places)


def weighted_mean(c: Column, weight: Column, places: int) -> Column:
    """Aggregate: average of ``c`` when each row stands for ``weight`` equal rows."""
    return ratio(F.sum(c * weight), F.sum(F.when(c.isNotNull(), weight)), places)


def pct_where(condition: Column, places: int) -> Column:
    """Aggregate: share of rows for which ``condition`` is true (NULL counts as no)."""
    return pct(F.count_if(condition), F.count(F.lit(1)), places)
