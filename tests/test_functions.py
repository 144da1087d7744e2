from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import ts
from pyspark.sql import functions as F

from bazaarlake.functions import (
    band,
    blank_to_default,
    date_key,
    days_between,
    mean_of,
    month_start,
    months_between_starts,
    pct,
    pct_where,
    ratio,
    strip_quotes,
    weighted_mean,
)


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expression).collect()]


def test_strip_quotes_takes_quotes_and_pad_spaces_only(spark):
    values = ['"a"', ' "a b" ', "\ta", '"', None, 'a"b"c']
    assert column(spark, values, "string", strip_quotes("x")) == [
        "a", "a b", "\ta", "", None, "abc",
    ]


def test_blank_to_default(spark):
    got = column(spark, ["", None, "x"], "string", blank_to_default(F.col("x"), "none"))
    assert got == ["none", "none", "x"]


@pytest.mark.parametrize(
    "closed,expected",
    [("left", ["a", "b", "b", "c", "c"]), ("right", ["a", "a", "b", "b", "c"])],
)
def test_band_edges_and_null(spark, closed, expected):
    banded = band(F.col("x"), [1, 2], ["a", "b", "c"], closed)
    values = [0.5, 1.0, 1.5, 2.0, None]
    assert column(spark, values, "double", banded) == expected


def test_band_needs_one_label_more(spark):
    with pytest.raises(ValueError):
        band(F.col("x"), [1, 2], ["a", "b"])


def test_days_between_counts_midnights(spark):
    df = spark.createDataFrame(
        [(ts("2018-01-01 23:59:00"), ts("2018-01-02 00:01:00"), ts("2018-01-01 00:00:01"))],
        "a timestamp_ntz, b timestamp_ntz, c timestamp_ntz",
    )
    row = df.select(
        days_between("a", "b").alias("ab"),
        days_between("a", "c").alias("ac"),
        days_between("b", "a").alias("ba"),
    ).first()
    assert (row.ab, row.ac, row.ba) == (1, 0, -1)


def test_months_and_keys(spark):
    df = spark.createDataFrame(
        [(ts("2017-12-31 10:00:00"), ts("2018-02-01 00:00:00"))],
        "a timestamp_ntz, b timestamp_ntz",
    ).select(F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    row = df.select(
        months_between_starts(F.col("a"), F.col("b")).alias("months"),
        month_start("a").alias("start"),
        date_key(F.col("a")).alias("key"),
    ).first()
    assert (row.months, row.start.isoformat(), row.key) == (2, "2017-12-01", 20171231)


def test_ratio_rounds_half_up_and_guards_zero(spark):
    df = spark.createDataFrame([(1003, 200), (1, 0), (None, 3)], "n long, d long")
    got = [r[0] for r in df.select(ratio(F.col("n"), F.col("d"), 2)).collect()]
    assert got == [5.02, None, None]
    assert df.filter("d = 200").select(pct(F.col("d"), F.col("n"), 1)).first()[0] == 19.9


def test_aggregates_skip_or_count_nulls(spark):
    df = spark.createDataFrame(
        [(Decimal("1.00"), 3), (None, 5), (Decimal("4.00"), 1)], "x decimal(18,2), w int"
    )
    row = df.agg(
        mean_of("x", 2).alias("mean"),
        weighted_mean(F.col("x"), F.col("w"), 2).alias("weighted"),
        pct_where(F.col("x") > 2, 1).alias("share"),
    ).first()
    assert (row["mean"], row["weighted"], row["share"]) == (2.5, 1.75, 33.3)
