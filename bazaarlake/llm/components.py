"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.session import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is its least node.

    Each round a node takes the least label among itself and its neighbours, then the
    label of that label, so the rounds grow with the logarithm of the longest path.
    Labels of a round are written and read again, which cuts the lineage. Only a count
    of changed labels reaches the driver. Links of a node with itself add a component of
    one; nulls are left out; repeated links change nothing.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    both = written(links.union(links.select("b", "a")).distinct(), "links")
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
            "node", F.least("node", "least").alias("component")
        ),
        "labels",
    )
    while True:
        around = (
            both.join(labels, both.b == labels.node)
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("least"))
        )
        nearer = labels.join(around, "node").select(
            "node", "component", F.least("component", "least").alias("next")
        )
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("further"))
        moved = nearer.join(jump, "next").select(
            "node", F.col("further").alias("next"), (F.col("further") != F.col("component")).alias("moved")
        )
        stage = written(moved, "labels")
        labels = stage.select("node", F.col("next").alias("component"))
        if stage.where("moved").isEmpty():
            return labels


def merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` after more links (a, b) between components, a node without links being its own."""
    more = components(links)
    further = more.select(F.col("node").alias("component"), F.col("component").alias("least"))
    return (
        found.join(further, "component", "left")
        .select("node", F.coalesce("least", "component").alias("component"))
        .union(more.join(found, "node", "left_anti"))
    )
