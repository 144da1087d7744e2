"""Table-driven banding of a numeric column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(
    c: Column, edges: Sequence[float], labels: Sequence[str], closed: str = "left"
) -> Column:
    """Label of the first band whose upper edge lies beyond the value.

    ``closed="left"`` keeps an edge value in the band above it (``x < edge``),
    ``closed="right"`` in the band below (``x <= edge``). Values past the last edge,
    and NULLs, take the last label.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges is needed")
    if closed not in ("left", "right"):
        raise ValueError("closed must be 'left' or 'right'")
    result = F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges, labels))):
        inside = c < F.lit(edge) if closed == "left" else c <= F.lit(edge)
        result = F.when(inside, F.lit(label)).otherwise(result)
    return result
