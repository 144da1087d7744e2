"""Near-duplicate vectors by sorted projection passes.

In each pass a vector gets a word of random hashes: the signs of its projections on
random directions, concatenated. Similar vectors agree in many signs, so in the order
of the words they stand close. Neighbouring windows of that order are compared exactly,
and the verified pairs of all passes are united. Where vectors are dense, more of them
share the start of a word than a window holds; such a run is then compared completely, as
far as its vectors are not in one component. Within the components found this way,
every pair is then compared, so no link between members is missing, however many they
are; pairs are counted where they are compared and never written out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from bazaarlake.llm.components import components, merged
from bazaarlake.operators.ranking import global_row_number
from bazaarlake.session import written

SIMILARITY = 0.9
BITS = 62
# Neighbours on each side that a vector is compared with, at least.
WINDOW = 256
# Vectors compared in one task, besides the window that follows them.
BLOCK = 1024
# Vectors of a run in one task: two parts of about so many.
RUN_PART = 512
# Chance that in no pass a pair of just the wanted similarity shares the start of its words.
MISSED = 0.02
MIN_PASSES = 8
# Members of a component compared in one task: two parts of about so many.
PART = 256


def start_bits(rows: int) -> int:
    """Signs at the start of a word that at most ``WINDOW`` of so many evenly spread rows share."""
    return min(BITS, max(0, math.ceil(math.log2(max(rows, 1) / WINDOW))))


def passes_for(rows: int, similarity: float = SIMILARITY) -> int:
    """Passes that keep the chance of missing a pair the same at every number of rows.

    Two vectors agree in a sign with 1 - angle / pi, wherever the others lie, and are
    compared in a pass if they agree in the first ``start_bits`` signs.
    """
    together = (1 - math.acos(similarity) / math.pi) ** start_bits(rows)
    if together >= 1 - MISSED:
        return MIN_PASSES
    return max(MIN_PASSES, math.ceil(math.log(MISSED) / math.log(1 - together)))


def usable_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, str]:
    """(id, content, data) and the number type of ``data``, a vector's components as bytes.

    Null, empty and zero vectors and such with null or non-finite components have null
    content and data. ``content`` is equal for equal vectors.
    """
    kind = vectors.schema[vector_column].dataType.elementType
    number = "<f4" if isinstance(kind, FloatType) else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for row in batch.column("vector"):
                values = row.values if row.is_valid else None
                data = None
                if values is not None and len(values) and not values.null_count:
                    x = values.to_numpy(zero_copy_only=False).astype(number)
                    if np.isfinite(x).all() and x.any():
                        data = (x + 0).tobytes()  # no negative zero, so equal vectors are equal
                cells.append(data)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(cells, pa.binary())], ["id", "data"]
            )

    named = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector_column}`").alias("vector")
    )
    usable = named.mapInArrow(run, "id long, data binary")
    return usable.withColumn("content", F.sha2("data", 256)), number


def unit_rows(cells: list[bytes], number: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each vector length, which cells have it, and their unit vectors in double precision."""
    sizes = np.array([len(cell) for cell in cells])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        x = np.frombuffer(b"".join([cells[i] for i in rows]), number).reshape(len(rows), -1)
        x = x.astype(np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
        yield rows, x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _words(passes: int, seed: int, number: str):
    """Adds the sorted-order word of every pass to each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[tuple[int, int], np.ndarray] = {}
        shifts = np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            for rows, x in unit_rows(batch.column("data").to_pylist(), number):
                size = x.shape[1]
                part = batch.take(pa.array(rows))
                for turn in range(passes):
                    if (size, turn) not in directions:
                        rng = np.random.default_rng([seed, turn, size])
                        directions[size, turn] = rng.normal(size=(size, BITS))
                    signs = (x @ directions[size, turn] > 0).astype(np.int64)
                    words = (signs << shifts).sum(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(np.full(len(x), turn, np.int32)), pa.array(words)],
                        ["rep", "data", "pass", "word"],
                    )

    return run


def _linked(x: np.ndarray, similarity: float) -> np.ndarray:
    return x @ x.T >= similarity


def _window_links(similarity: float, number: str):
    """Of each block, every linked vector with the least one it reaches there."""

    def run(window: pd.DataFrame) -> pd.DataFrame:
        ids = window["rep"].to_numpy()
        a, b = [], []
        for rows, x in unit_rows(window["data"].to_list(), number):
            linked = _linked(x, similarity)
            label = ids[rows].copy()
            while True:
                least = np.where(linked, label, np.iinfo(np.int64).max).min(axis=1)
                if (least == label).all():
                    break
                label = least
            apart = label != ids[rows]
            a.append(ids[rows][apart])
            b.append(label[apart])
        empty = np.zeros(0, np.int64)
        return pd.DataFrame({"a": np.concatenate([empty, *a]), "b": np.concatenate([empty, *b])})

    return run


def _run_links(similarity: float, number: str):
    """Links that join up the components of two parts of a run (or of one)."""

    def run(pair: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        for rows, x in unit_rows(pair["data"].to_list(), number):
            own = pair["component"].to_numpy()[rows]
            linked = _linked(x, similarity) & (own[:, None] != own[None, :])
            for i in np.flatnonzero(linked.any(axis=1)):
                others = np.unique(own[linked[i]])
                a.append(np.full(len(others), own[i]))
                b.append(others)
        empty = np.zeros(0, np.int64)
        found = pd.DataFrame({"a": np.concatenate([empty, *a]), "b": np.concatenate([empty, *b])})
        return found[found["a"] < found["b"]].drop_duplicates()

    return run


def _dense_links(
    placed: DataFrame, found: DataFrame, classes: DataFrame, bits: int, similarity: float, number: str
) -> DataFrame:
    """Links between components, from runs of equal word starts that no window holds."""
    starts = placed.select(
        F.col("rep").alias("node"), "pass", F.shiftright("word", BITS - bits).alias("start")
    )
    labelled = written(
        starts.join(found, "node", "left").select(
            "node", "pass", "start", F.coalesce("component", "node").alias("component")
        ),
        "word-starts",
    )
    runs = (
        labelled.groupBy("pass", "start")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.min("component").alias("least"),
            F.max("component").alias("most"),
        )
        # Vectors up to a window apart in the order have met in a block.
        .where((F.col("size") > WINDOW + 1) & (F.col("least") != F.col("most")))
        .select("pass", "start", F.ceil(F.col("size") / RUN_PART).alias("parts"))
    )
    spread = labelled.join(runs, ["pass", "start"]).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts"))
    )
    meeting = (
        spread.join(classes.select(F.col("rep").alias("node"), "data"), "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "pass", "start", "component", "data",
            F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        )
    )
    return written(
        meeting.groupBy("pass", "start", "low", "high")
        .applyInPandas(_run_links(similarity, number), "a long, b long")
        .distinct(),
        "links-between",
    )


def _part_counts(similarity: float, number: str):
    """Links that members of two parts (or of one) have with each other, weighted by copies."""

    def run(pair: pd.DataFrame) -> pd.DataFrame:
        found = []
        for rows, x in unit_rows(pair["data"].to_list(), number):
            part, weight = pair["part"].to_numpy()[rows], pair["weight"].to_numpy()[rows]
            linked = _linked(x, similarity)
            np.fill_diagonal(linked, False)
            if pair["low"].iloc[0] != pair["high"].iloc[0]:
                linked &= part[:, None] != part[None, :]
            found.append(pd.DataFrame({"rep": pair["rep"].to_numpy()[rows], "links": linked @ weight}))
        return pd.concat(found)

    return run


def near_duplicates(
    vectors: DataFrame,
    id_column: str,
    vector_column: str,
    similarity: float = SIMILARITY,
    seed: int = 42,
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id`` and ``kept``.

    Two vectors are linked if they have the same length and a cosine of at least
    ``similarity`` in double precision. ``component_id`` is the least id reachable by
    links, ``kept`` says it is the vector's own. Equal vectors are one class with a
    weight until the end; rows of one id are vectors of their own and copies if equal.
    Unusable vectors (null, empty, zero, with null or non-finite components) have no
    links. Other columns are not read; an empty table gives no rows.

    What a pass finds depends on the random directions; ``passes_for`` sets their number
    so that a pair is missed with a chance of ``MISSED`` at most, however the vectors lie.
    A run of r vectors that share the start of a word and are not linked together takes
    r * r / 2 comparisons; directions are not centred on the table's mean, as that chance
    holds for the vectors' own angles only. Every component's pairs
    are compared in blocks, so a component of c different vectors takes c * c / 2
    comparisons and c * c / PART rows of work.
    """
    name = F.col("id").alias(id_column)
    usable, number = usable_vectors(vectors, id_column, vector_column)
    units = written(usable, "usable-vectors")
    classes = written(
        units.where("data IS NOT NULL")
        .groupBy("content")
        .agg(
            F.min("id").alias("rep"),
            F.count(F.lit(1)).alias("weight"),
            F.first("data").alias("data"),
        ),
        "vector-classes",
    )
    rows = classes.count()
    passes = passes_for(rows, similarity)
    words = classes.select("rep", "data").mapInArrow(
        _words(passes, seed, number), "rep long, data binary, pass int, word long"
    )
    placed = global_row_number(words, "place", ["pass", "word", "rep"])
    block, inside = F.floor((F.col("place") - 1) / BLOCK), (F.col("place") - 1) % BLOCK
    # The first vectors of a block also follow the block before it.
    blocks = F.when(inside < WINDOW, F.array(block, block - 1)).otherwise(F.array(block))
    links = written(
        placed.select("rep", "data", F.explode(blocks).alias("block"))
        .groupBy("block")
        .applyInPandas(_window_links(similarity, number), "a long, b long"),
        "window-links",
    )
    near = components(links)
    dense = _dense_links(placed, near, classes, start_bits(rows), similarity, number)
    found = written(merged(near, dense), "vector-components")

    members = found.join(classes, found.node == classes.rep).select("component", "rep", "weight", "data")
    sizes = found.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"))
    spread = members.join(sizes, "component").withColumn(
        "part", F.pmod(F.xxhash64("rep"), F.col("parts"))
    )
    meeting = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "component", "rep", "weight", "data", "part",
        F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
    )
    counted = (
        meeting.groupBy("component", "low", "high")
        .applyInPandas(_part_counts(similarity, number), "rep long, links long")
        .groupBy("rep")
        .agg(F.sum("links").alias("links"))
    )
    judged = (
        classes.drop("data")
        .join(found.withColumnRenamed("node", "rep"), "rep", "left")
        .join(counted, "rep", "left")
        .select(
            "content",
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    usable = units.where("content IS NOT NULL").select("id", "content").join(judged, "content")
    without = units.where("content IS NULL").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return usable.select("id", "n_links", "component_id").union(without).select(
        name, "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    )
