"""Bring Spark results to the types the SQL side of a check returns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DecimalType, FloatType, IntegralType


def comparable(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT, decimals as DOUBLE; all else as it is."""
    columns = []
    for field in df.schema:
        if isinstance(field.dataType, IntegralType):
            columns.append(f"CAST({field.name} AS BIGINT) AS {field.name}")
        elif isinstance(field.dataType, (DecimalType, FloatType)):
            columns.append(f"CAST({field.name} AS DOUBLE) AS {field.name}")
        else:
            columns.append(field.name)
    return df.selectExpr(*columns)
