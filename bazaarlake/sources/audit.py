"""Load audit: rows, rejects and seconds per table, counted while the load runs."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = (
    "layer string, table_name string, rows_written bigint, rows_rejected bigint,"
    " seconds double, status string"
)


@dataclass(frozen=True)
class TableLoad:
    layer: str
    table_name: str
    rows_written: int
    rows_rejected: int
    seconds: float
    status: str


# Table name of the row that sums up a batch.
BATCH = "(batch)"


class LoadError(RuntimeError):
    """A load did not finish; ``audit`` tells what each table came to."""

    def __init__(self, message: str, audit: list[TableLoad]):
        super().__init__(message)
        self.audit = audit


class TooManyRejects(RuntimeError):
    """A file holds more bad lines than the load tolerates; ``load`` is what was counted."""

    def __init__(self, message: str, load: TableLoad):
        super().__init__(message)
        self.load = load


def timed_load(
    layer: str,
    name: str,
    df: DataFrame,
    write: Callable[[DataFrame, Callable[[], None]], None],
    rejects: Column | None = None,
    tolerated: Callable[[int, int], bool] = lambda lines, rows: True,
) -> TableLoad:
    """Run ``write`` on ``df`` and count what passes through, without a second scan.

    ``rejects`` is the number of bad lines a row stands for, 0 for a good one. ``write``
    gets a check to run before it replaces anything: it raises where ``tolerated`` is
    false for the bad lines and all rows.
    """
    seen = Observation(f"{layer}.{name}")
    lines = F.lit(0) if rejects is None else rejects
    started = time.monotonic()

    def counted(status: str) -> TableLoad:
        counts = seen.get
        good = counts["good"] if status == "loaded" else 0
        return TableLoad(layer, name, good, counts["lines"], time.monotonic() - started, status)

    def check() -> None:
        counts = seen.get
        if not tolerated(counts["lines"], counts["good"] + counts["lines"]):
            raise TooManyRejects(f"{counts['lines']} bad lines are too many", counted("failed"))

    observed = df.observe(
        seen,
        F.count_if(lines == 0).alias("good"),
        F.coalesce(F.sum(lines), F.lit(0)).cast("long").alias("lines"),
    )
    write(observed, check)
    return counted("loaded")


def run_loads(
    loads: dict[str, Callable[[], TableLoad]], layer: str, parallel: int
) -> list[TableLoad]:
    """Run independent loads side by side; raise after all ended if any failed."""
    audit: list[TableLoad] = []
    failures: list[tuple[str, Exception]] = []
    started = time.monotonic()
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        running = {name: pool.submit(load) for name, load in loads.items()}
        for name, outcome in running.items():
            try:
                audit.append(outcome.result())
            except TooManyRejects as error:
                failures.append((name, error))
                audit.append(error.load)
            except Exception as error:  # recorded here, raised below
                failures.append((name, error))
                spent = time.monotonic() - started
                audit.append(TableLoad(layer, name, 0, 0, spent, "failed"))
    if failures:
        name, error = failures[0]
        whole = [*audit, batch_total(layer, audit, time.monotonic() - started)]
        raise LoadError(f"{layer}.{name}: {error}", whole) from error
    return audit


def batch_total(layer: str, audit: list[TableLoad], seconds: float) -> TableLoad:
    """One row for the whole batch of a layer, with the time it took from start to end."""
    return TableLoad(
        layer,
        BATCH,
        sum(load.rows_written for load in audit),
        sum(load.rows_rejected for load in audit),
        seconds,
        "loaded" if all(load.status == "loaded" for load in audit) else "failed",
    )


def audit_frame(spark: SparkSession, audit: list[TableLoad]) -> DataFrame:
    return spark.createDataFrame([astuple(load) for load in audit], AUDIT_SCHEMA)
