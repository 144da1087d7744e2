"""Global row numbers and tiles without a single-partition window.

``ROW_NUMBER() OVER (ORDER BY ...)`` over a whole table plans one task for all rows.
Here the rows are range partitioned (Spark samples the keys and balances the ranges,
also inside a run of equal leading keys, as the full sort key counts) and sorted
per partition. ``monotonically_increasing_id`` then carries the partition number
and the position inside it, the rows are written once, and each partition's offset
is a running sum over one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.session import written
from bazaarlake.sources.tables import COMPRESSION

_POSITION_BITS = 33  # layout of monotonically_increasing_id


def _positions(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """Add ``_rank`` (1..N) and ``_total`` (N)."""
    # No partition count: spark.sql.shuffle.partitions bounds it, and the adaptive
    # planner merges neighbours that are small, which keeps the order of the ranges.
    placed = written(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id()),
        label,
        COMPRESSION,
    ).withColumn("_part", F.shiftright("_id", _POSITION_BITS))

    # One row per partition from here on: bounded by the partition count.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(
            "_part",
            F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
            F.sum("_size").over(Window.partitionBy()).alias("_total"),
        )
    )
    in_part = F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn("_rank", F.col("_offset") + in_part + 1)
        .drop("_id", "_part", "_offset")
    )


def global_row_number(
    df: DataFrame, name: str, order: Sequence[Column | str]
) -> DataFrame:
    """Add ``name``: 1..N in ``order``. The order must be total to be repeatable."""
    columns = [F.col(o) if isinstance(o, str) else o for o in order]
    ranked = _positions(df, columns, f"rank-{name}")
    return ranked.withColumn(name, F.col("_rank")).drop("_rank", "_total")


def add_surrogate_key(df: DataFrame, name: str, key: str) -> DataFrame:
    """Dense key 1..N by ``key``, as the first column."""
    return global_row_number(df, name, [key]).select(name, *df.columns)


def global_ntile(
    df: DataFrame, tiles: int, name: str, order: Sequence[Column | str]
) -> DataFrame:
    """Add ``name``: NTILE(tiles) in ``order``; the first N mod tiles hold one row more."""
    columns = [F.col(o) if isinstance(o, str) else o for o in order]
    ranked = _positions(df, columns, f"tile-{name}")
    tile = F.expr(
        f"""CASE WHEN _rank <= (_total % {tiles}) * (_total div {tiles} + 1)
                 THEN (_rank - 1) div (_total div {tiles} + 1) + 1
                 ELSE (_total % {tiles}) + 1
                      + (_rank - 1 - (_total % {tiles}) * (_total div {tiles} + 1))
                        div greatest(_total div {tiles}, 1)
            END"""
    )
    return ranked.withColumn(name, tile.cast("int")).drop("_rank", "_total")
