"""Small helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from bazaarlake.session import scratch_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str, chars: int = 4_000_000
) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that one slice holds about ``chars`` bytes of ``column`` at most.

    A single longer text is a slice of its own, so memory follows the longest text.
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start = held = 0
        for row, size in enumerate(sizes):
            if held and held + size > chars:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def texts_of(column: pa.Array) -> list[str]:
    """The column's texts, null as the empty text."""
    return [text or "" for text in column.to_pylist()]


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` in the cluster's checkpoint folder, its partitions and their order kept."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint()
