"""Layer tables: parquet folders replaced as a whole by each load."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Tables are written once and kept; this takes a third to a half off Spark's default.
COMPRESSION = "zstd"


def replace_table(
    df: DataFrame, path: str, accept: Callable[[], None] = lambda: None
) -> None:
    """Full refresh: write ``df`` beside the table, ask ``accept``, then swap the two.

    Where the write fails or ``accept`` raises, the table stays as it was. ``df`` may
    read the table it replaces.
    """
    spark = df.sparkSession
    fresh, old = (f"{path}-{state}-{uuid.uuid4().hex}" for state in ("new", "old"))
    try:
        df.write.parquet(fresh, compression=COMPRESSION)
        accept()
        files, (here, new, before) = _paths(spark, path, fresh, old)
        if files.exists(here) and not files.rename(here, before):
            raise OSError(f"{path} could not be moved away")
        if not files.rename(new, here):
            files.rename(before, here)
            raise OSError(f"{fresh} could not be moved to {path}")
        files.delete(before, True)
    except BaseException:
        files, (new,) = _paths(spark, fresh)
        files.delete(new, True)
        raise


def _paths(spark: SparkSession, *names: str) -> tuple[JavaObject, list[JavaObject]]:
    """The file system of the first path, and all paths as it takes them."""
    paths = [spark._jvm.org.apache.hadoop.fs.Path(name) for name in names]
    return paths[0].getFileSystem(spark._jsc.hadoopConfiguration()), paths


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)
