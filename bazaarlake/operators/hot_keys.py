"""Keys that hold so many rows that one task should not get all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with fewer rows is no burden to a task, whatever its share.
HOT_ROWS = 100_000
# Counters kept per task. Keys with more than about 7 / 16,384 of the rows are surely found.
TRACKED = 10_000


def hot_keys(rows: DataFrame, key: str, at_least: int | None = None) -> list:
    """Keys of ``rows`` with ``at_least`` rows (``HOT_ROWS``), in order.

    One pass that shuffles nothing but a bounded sketch per task; it runs at once. There are
    no more such keys than rows / ``at_least``. Who uses them may only balance work by them:
    a key the sketch has lost among many others must give the same result.
    """
    floor = HOT_ROWS if at_least is None else at_least
    found = rows.select(
        F.inline(F.expr(f"approx_top_k({key}, {TRACKED}, {TRACKED})"))
    ).filter((F.col("count") >= floor) & F.col("item").isNotNull())
    return sorted(row["item"] for row in found.collect())


# Parts of a hot key's rows in ``folded_per_key``.
PARTS = 64


def folded_per_key(
    rows: DataFrame, key: str, group: str, facts: DataFrame, hot: DataFrame, *folds: Column
) -> DataFrame:
    """``rows`` joined to the ``facts`` of their ``key`` and folded to one per key and ``group``.

    Rows are shuffled once, by the key, joined and folded in one task. ``hot`` names the keys
    (few enough to broadcast) whose rows are spread over ``PARTS`` tasks by their group; the
    facts of those are repeated as often.
    """
    known = F.broadcast(hot.select(key).distinct().withColumn("_hot", F.lit(True)))
    part = F.pmod(F.xxhash64(group), F.lit(PARTS)).cast("int")
    parts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(
        F.array(F.lit(0))
    )
    placed = (
        rows.join(known, key, "left")
        .withColumn("_part", F.when(F.col("_hot"), part).otherwise(0))
        .drop("_hot")
        .repartition(key, "_part")
    )
    spread = facts.join(known, key, "left").withColumn("_part", F.explode(parts)).drop("_hot")
    joined = placed.join(spread, [key, "_part"])
    return joined.groupBy(key, "_part", group).agg(*folds).drop("_part")
