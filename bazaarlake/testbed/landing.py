"""Write the derived retail tables as the raw CSV files a load would find."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.config import WarehouseConfig
from bazaarlake.plans.pipeline import load_bronze, load_gold, load_silver
from bazaarlake.session import scratch_path, shuffles_dropped, written
from bazaarlake.sources.audit import audit_frame
from bazaarlake.sources.csv_files import (
    SOURCES,
    TIMESTAMP,
    accepted,
    read_raw,
    rejected,
)
from bazaarlake.testbed.fixture import PARAMS, raw_tables

# Payment lines with a value that is no number, with missing and with surplus fields.
BROKEN_PAYMENTS_SQL = """SELECT CASE o_orderkey % 50
    WHEN 7 THEN 'o' || CAST(o_orderkey AS STRING) || ',1,boleto,1,n/a'
    WHEN 9 THEN 'o' || CAST(o_orderkey AS STRING) || ',1,boleto'
    WHEN 11 THEN 'o' || CAST(o_orderkey AS STRING) || ',1,boleto,1,2.50,surplus'
    ELSE 'o' || CAST(o_orderkey AS STRING) || ',1,boleto,,2.50' END AS line
FROM orders"""
# Compressed files do not split: a file holds no more than one task should read.
RECORDS_PER_FILE = 1_000_000


def land(spark: SparkSession, sf_dir: str, name: str, path: str) -> None:
    """Write one source in its file format (values bring their own quotes)."""
    source = SOURCES[name]
    own_quotes = not source.line_breaks_in_text
    rows = raw_tables(spark, sf_dir)(name)
    if source.line_breaks_in_text:
        # The CSV writer turns every LF of a value into the line end, here CR LF.
        message = F.replace("review_comment_message", F.lit("\r\n"), F.lit("\n"))
        rows = rows.withColumn("review_comment_message", message)
    rows.write.options(
        header="true",
        lineSep=source.line_end,
        quote="" if own_quotes else '"',
        escape='"',
        quoteAll=str(not own_quotes).lower(),
        nullValue="",
        timestampNTZFormat=TIMESTAMP,
        compression="gzip",
        maxRecordsPerFile=RECORDS_PER_FILE,
    ).csv(path)


def landed_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source written to the shared folder and read back by the raw reader."""
    path = scratch_path(spark, f"landing-{name}")
    land(spark, sf_dir, name, path)
    return accepted(read_raw(spark, SOURCES[name], path, raw_quotes=True))


def landed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad lines of a payment file that holds three kinds of them."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.sql(BROKEN_PAYMENTS_SQL.replace("FROM orders", "FROM {orders}"), orders=orders)
    path = scratch_path(spark, "landing-broken")
    lines.write.text(path)
    # These lines have no header, which a load takes from the first line of a file.
    source = SOURCES["order_payments"]
    landed = read_raw(spark, source, path, raw_quotes=True, header=False)
    return rejected(written(landed, "landed-broken"), source.name)


def landed_warehouse(spark: SparkSession, sf_dir: str) -> WarehouseConfig:
    """All sources written as files, ready for the loads."""
    root = scratch_path(spark, "warehouse")
    config = WarehouseConfig(
        source_root=f"{root}/files", warehouse_root=root, raw_quotes=True, params=PARAMS
    )
    with shuffles_dropped(spark):
        for name in SOURCES:
            land(spark, sf_dir, name, config.source_path(name))
    return config


@cache
def _loaded_once(application_id: str, sf_dir: str) -> dict[str, WarehouseConfig]:
    return {}


def loaded_warehouse(spark: SparkSession, sf_dir: str) -> WarehouseConfig:
    """All three layers written from the landed files, once per application."""
    known = _loaded_once(spark.sparkContext.applicationId, sf_dir)
    if not known:
        config = landed_warehouse(spark, sf_dir)
        load_bronze(spark, config)
        load_silver(spark, config)
        load_gold(spark, config)
        known["config"] = config
    return known["config"]


def landed_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of loading all files into the raw and the cleansed layer."""
    config = landed_warehouse(spark, sf_dir)
    audit = load_bronze(spark, config) + load_silver(spark, config)
    return audit_frame(spark, audit).drop("seconds")
