"""Many-to-one joins that stay balanced when one key holds much of the data.

A lookup whose source files are below ``spark.sql.autoBroadcastJoinThreshold`` is
broadcast. Beyond that size the join shuffles, and a hot key would put its whole group
into one task. ``lookup_join`` then spreads each lookup key over a fixed number of
salts: the lookup side, which is far smaller than the rows it describes, is repeated
per salt and the rows pick one salt each. A load that has counted its keys names the
hot ones and repeats no other. Both sides are fresh shuffles, so the
adaptive skew join can split further at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.session import setting_bytes

SALTS = 16


def estimated_bytes(df: DataFrame) -> int:
    """Size of ``df`` as far as it can be known before it runs.

    Catalyst multiplies both sides of an outer join. A lookup is built of scans,
    filters, aggregates and other many-to-one joins, none of which adds rows, so the
    tables it reads bound it as well; the smaller of the two counts.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    read = sum(
        int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())
    )
    return min(int(str(plan.stats().sizeInBytes())), read)


def broadcast_limit(df: DataFrame) -> int:
    return setting_bytes(df.sparkSession, "spark.sql.autoBroadcastJoinThreshold")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str = "left",
    spread: Sequence[str] | None = None,
    salts: int = SALTS,
    hot: Sequence[str] | None = None,
) -> DataFrame:
    """Join ``rows`` to ``lookup`` on ``on``; a row matches what a plain join matches.

    ``spread`` names columns that differ between rows of one hot key; their hash
    picks the salt, so a retried task routes each row the same way again. Where the
    ``hot`` keys are known, only these are salted and repeated, all others as they are.
    """
    if estimated_bytes(lookup) <= broadcast_limit(lookup):
        return rows.join(F.broadcast(lookup), on, how)
    if hot is not None and not hot:
        return rows.join(lookup, on, how)
    spread_over = list(spread or [c for c in rows.columns if c != on])
    salt = F.pmod(F.xxhash64(*spread_over), F.lit(salts)).cast("int")
    repeats = F.sequence(F.lit(0), F.lit(salts - 1))
    if hot is not None:
        is_hot = F.col(on).isin(*hot)
        salt = F.when(is_hot, salt).otherwise(0)
        repeats = F.when(is_hot, repeats).otherwise(F.array(F.lit(0)))
    salted_rows = rows.withColumn("_salt", salt)
    salted_lookup = lookup.withColumn("_salt", F.explode(repeats))
    return salted_rows.join(salted_lookup, [on, "_salt"], how).drop("_salt")


def lookup_with_fallback(
    rows: DataFrame,
    lookup: DataFrame,
    key: Column,
    lookup_key: str,
    value: str,
    out: str,
    fallbacks: Sequence[Column],
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``out``: the looked-up value, or the first fallback that is not NULL.

    The lookup is first reduced to one row per key, so the grain of ``rows`` is kept.
    """
    unique = lookup.groupBy(F.col(lookup_key).alias("_lookup_key")).agg(
        F.min(value).alias("_lookup_value")
    )
    joined = lookup_join(
        rows.withColumn("_lookup_key", key), unique, "_lookup_key", "left", spread
    )
    return joined.withColumn(
        out, F.coalesce(F.col("_lookup_value"), *fallbacks)
    ).drop("_lookup_key", "_lookup_value")
