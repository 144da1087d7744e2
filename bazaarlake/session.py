"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans count on. Partition counts and memory belong to
# the cluster and are left alone.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app: str = "bazaarlake", master: str | None = None, **conf: str
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_DEFAULTS, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def setting_bytes(spark: SparkSession, key: str) -> int:
    """A size setting such as ``128MB`` in bytes, as Spark reads it; -1 where it is switched off."""
    setting = spark.conf.get(key).strip()
    if setting.startswith("-"):
        return -1
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting)


@cache
def _local_scratch(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"bazaarlake-{application_id}-")


def scratch_root(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables, below the one the cluster names.

    Only a ``local[*]`` session, where driver and executors are one process, may
    fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root}/bazaarlake/{context.applicationId}"
    if not context.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder all executors share"
        )
    return _local_scratch(context.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once no result reads them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Intermediate tables of ``written`` by the name of their folder, which is used once.
_WRITTEN: dict[str, str] = {}


def written(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Cuts lineage: what follows reads fixed files, so a lost executor re-reads them
    instead of recomputing (and possibly re-ordering) the rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    _WRITTEN[path.rsplit("/", 1)[-1]] = path
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the intermediate tables ``df`` reads, once nothing reads them any more."""
    spark = df.sparkSession
    for name in {file.rsplit("/", 2)[-2] for file in df.inputFiles()} & {*_WRITTEN}:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop(name))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query are deleted when it ends, not when its plan is collected.

    For queries that run once, such as the writes of a load: one that ran a second time
    would have to shuffle again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
