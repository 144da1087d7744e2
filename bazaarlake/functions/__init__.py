"""Column -> Column helpers. All of them are built-in JVM expressions."""

from bazaarlake.functions.banding import band
from bazaarlake.functions.dates import (
    date_key,
    days_between,
    month_start,
    months_between_starts,
)
from bazaarlake.functions.numeric import (
    mean_of,
    pct,
    pct_where,
    ratio,
    rounded,
    weighted_mean,
)
from bazaarlake.functions.text import blank_to_default, blank_to_null, strip_quotes

__all__ = [
    "band",
    "blank_to_default",
    "blank_to_null",
    "date_key",
    "days_between",
    "mean_of",
    "month_start",
    "months_between_starts",
    "pct",
    "pct_where",
    "ratio",
    "rounded",
    "strip_quotes",
    "weighted_mean",
]
