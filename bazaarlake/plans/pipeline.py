"""Full-refresh loads of the three layers, and their registration for SQL users.

Every load replaces its table as a whole, once the new rows are written and accepted,
counts rows and rejects on the way through and raises when something went wrong, after
recording which table it was. A failed load leaves the table as it was.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import nullcontext
from functools import partial
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from bazaarlake.config import WarehouseConfig
from bazaarlake.plans.silver import build_silver
from bazaarlake.plans.warehouse import DIMENSIONS, FACTS, GOLD_TABLES, Warehouse
from bazaarlake.session import drop_written, shuffles_dropped
from bazaarlake.sources.audit import TableLoad, batch_total, run_loads, timed_load
from bazaarlake.sources.csv_files import SOURCES, CsvSource, bad_lines, read_raw
from bazaarlake.sources.schemas import SILVER
from bazaarlake.sources.tables import read_table, replace_table

_LOOKUP = "product_category_translation"


def _batch(
    spark: SparkSession, layer: str, load: Callable[[], list[TableLoad]]
) -> list[TableLoad]:
    """The loads of a layer and a row for all of them together."""
    started = time.monotonic()
    with shuffles_dropped(spark):
        audit = load()
    return [*audit, batch_total(layer, audit, time.monotonic() - started)]


def _load_source(
    spark: SparkSession, config: WarehouseConfig, source: CsvSource
) -> TableLoad:
    path = config.table_path("bronze", source.name)
    landed = read_raw(spark, source, config.source_path(source.name), config.raw_quotes)

    def tolerated(lines: int, rows: int) -> bool:
        return lines <= config.max_errors or lines <= config.max_error_share * rows

    return timed_load(
        "bronze",
        source.name,
        landed,
        lambda df, check: replace_table(df, path, check),
        bad_lines(source),
        tolerated,
    )


def load_bronze(spark: SparkSession, config: WarehouseConfig) -> list[TableLoad]:
    """Read the nine files into raw tables. Bad lines stay there, apart from the rows.

    More bad lines than ``max_errors``, and than ``max_error_share`` of a file, fail its
    load; its table then stays as the last good load left it.
    """
    loads = {
        name: partial(_load_source, spark, config, source)
        for name, source in SOURCES.items()
    }
    return _batch(spark, "bronze", lambda: run_loads(loads, "bronze", config.parallel_loads))


def load_silver(spark: SparkSession, config: WarehouseConfig) -> list[TableLoad]:
    """Cleanse the raw tables. Only products wait: they look up the cleansed translation."""
    raw = Warehouse.from_tables(spark, config).raw

    def load(name: str) -> TableLoad:
        path = config.table_path("silver", name)
        lookup = None
        if name == "products":
            lookup = read_table(spark, config.table_path("silver", _LOOKUP), SILVER[_LOOKUP])
        df = build_silver(name, raw, lookup)
        return timed_load("silver", name, df, lambda out, check: replace_table(out, path, check))

    def load_all() -> list[TableLoad]:
        first = run_loads({_LOOKUP: partial(load, _LOOKUP)}, "silver", 1)
        others = {name: partial(load, name) for name in SILVER if name != _LOOKUP}
        return first + run_loads(others, "silver", config.parallel_loads)

    return _batch(spark, "silver", load_all)


def _laid_out(name: str, df: DataFrame) -> DataFrame:
    """Rows in the order of purchase time, so that a month window skips most of each file.

    They stay in the tasks that joined them: spreading the wide rows over files by time
    would send all of them through one more shuffle.
    """
    if name == "fact_orders":
        return df.sortWithinPartitions("order_purchase_timestamp", "order_id")
    if name == "fact_order_items":
        return df.sortWithinPartitions("order_purchase_timestamp")
    return df


def load_gold(spark: SparkSession, config: WarehouseConfig) -> list[TableLoad]:
    """Write the star schema: dimensions first, then facts with the keys just written."""
    # The two facts that shuffle most take turns: their shuffles never lie on disk together.
    turn = Lock()

    def load(wh: Warehouse, name: str) -> TableLoad:
        path = config.table_path("gold", name)
        table = wh.gold(name)
        df = _laid_out(name, table)
        try:
            with turn if name in ("fact_order_items", "fact_orders") else nullcontext():
                return timed_load(
                    "gold", name, df, lambda out, check: replace_table(out, path, check)
                )
        finally:
            if name in DIMENSIONS:
                drop_written(table)  # its numbered rows

    def load_all() -> list[TableLoad]:
        over_silver = Warehouse.from_tables(spark, config)
        audit = run_loads(
            {name: partial(load, over_silver, name) for name in DIMENSIONS},
            "gold",
            config.parallel_loads,
        )
        over_dims = Warehouse.from_tables(spark, config, gold=DIMENSIONS)
        over_dims.share_orders()
        loads = {name: partial(load, over_dims, name) for name in FACTS}
        try:
            return audit + run_loads(loads, "gold", config.parallel_loads)
        finally:
            over_dims.drop_shared_orders()

    return _batch(spark, "gold", load_all)


def register_tables(spark: SparkSession, config: WarehouseConfig) -> None:
    """Make the loaded layers known as ``bronze.x``, ``silver.x`` and ``gold.x``."""
    layers = {"bronze": list(SOURCES), "silver": list(SILVER), "gold": list(GOLD_TABLES)}
    for layer, names in layers.items():
        root = config.table_path(layer, "")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root}'")
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
            path = config.table_path(layer, name)
            spark.sql(f"CREATE TABLE {layer}.{name} USING parquet LOCATION '{path}'")


def register_views(wh: Warehouse) -> None:
    """Live views ``silver_x`` and ``gold_x`` over whatever the warehouse reads now."""
    for name in SILVER:
        wh.silver(name).createOrReplaceTempView(f"silver_{name}")
    for name in GOLD_TABLES:
        wh.gold(name).createOrReplaceTempView(f"gold_{name}")
