"""Text clean-up for raw CSV fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_quotes(c: str | Column) -> Column:
    """Drop literal double quotes, then pad spaces (spaces only, not tabs or CR)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.replace(c, F.lit('"'), F.lit("")))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def blank_to_default(c: Column, default: str) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(default))
