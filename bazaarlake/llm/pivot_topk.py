"""Exact top-k by inner product over a pivot-distance index.

With one more component a largest inner product becomes a least distance: a vector v of
length |v| gets sqrt(M * M - |v| * |v|), M the greatest length, a query gets 0, and

    distance(q, v) ** 2 = |q| ** 2 + M * M - 2 * (q . v).

Every vector is keyed by its nearest pivot and its distance to it. Sorted by that key
and cut into blocks, the index is a set of annuli around pivots. For a query at distance
d of a pivot, nothing in an annulus from a to b is nearer than max(a - d, d - b). The
nearest annuli give a first k best; then all annuli are searched that this bound does
not rule out. Scores are exact integers; distances only ever rule out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.session import written

SCALE = 1024
PIVOTS = 32
# Pivots are chosen among at most so many vectors, taken by a hash of their ids.
SAMPLE_ROWS = 2048
BLOCK = 512
# Queries that meet a block in one row.
QUERY_BLOCK = 256
# Annuli searched first.
NEAREST = 3
# Relative slack of the bounds, far above the rounding of doubles.
SLACK = 1e-9
# Whole numbers up to here are exact in double precision.
EXACT = 1 << 53


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, size, length2, data): floor(SCALE * x) of usable vectors as 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"id": [], "size": [], "length2": [], "data": []}
            for number, row in zip(batch.column("id").to_pylist(), batch.column("vector"), strict=True):
                values = row.values if row.is_valid else None
                if values is None or not len(values) or values.null_count:
                    continue
                x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                whole = np.floor(SCALE * x)
                out["id"].append(number)
                out["size"].append(len(x))
                out["length2"].append(float(whole @ whole))
                out["data"].append(whole.astype(np.int64).tobytes())
            yield pa.RecordBatch.from_pydict(
                out,
                schema=pa.schema(
                    [("id", pa.int64()), ("size", pa.int32()), ("length2", pa.float64()), ("data", pa.binary())]
                ),
            )

    named = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector_column}`").alias("vector")
    )
    return named.mapInArrow(run, "id long, size int, length2 double, data binary")


def _matrix(cells: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(cells), np.int64).reshape(len(cells), -1)


def choose_pivots(whole: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length, pivots far from each other among a bounded sample."""
    sample = whole.orderBy(F.xxhash64("id", F.lit(5)), "id", "data").limit(SAMPLE_ROWS).collect()
    pivots = {}
    for size in {row["size"] for row in sample}:
        x = _matrix(sorted({bytes(r.data) for r in sample if r["size"] == size})).astype(np.float64)
        chosen = [int(np.argmax(((x - x.mean(axis=0)) ** 2).sum(axis=1)))]
        far = ((x - x[chosen[0]]) ** 2).sum(axis=1)
        while len(chosen) < min(PIVOTS, len(x)) and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
        pivots[size] = x[chosen]
    return pivots


def _distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to pivots whose further component is 0."""
    squares = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(0, squares + (extra * extra)[:, None]))


def _placed(whole: DataFrame, pivots: dict[int, np.ndarray], greatest2: float, query: bool) -> DataFrame:
    """Adds the nearest pivot and the distance to it, or to all of them for a query."""
    extra_type = "distances array<double>" if query else "pivot int, distance double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                rows = pa.array(np.flatnonzero(sizes == size))
                part = batch.take(rows)
                x = _matrix(part.column("data").to_pylist()).astype(np.float64)
                around = pivots.get(int(size), np.zeros((1, int(size))))
                above = np.zeros(len(x)) if query else np.sqrt(
                    np.maximum(0, greatest2 - part.column("length2").to_numpy())
                )
                distances = _distances(x, above, around)
                nearest = distances.argmin(axis=1)
                if query:
                    more = {"distances": pa.array(list(distances))}
                else:
                    least = distances[np.arange(len(x)), nearest]
                    more = {"pivot": pa.array(nearest, pa.int32()), "distance": pa.array(least)}
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *more.values()], [*part.schema.names, *more]
                )

    return whole.mapInArrow(run, f"id long, size int, length2 double, data binary, {extra_type}")


_BLOCK_COLUMNS = "block long, size int, pivot int, low double, high double, ids array<long>, data binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts sorted rows of one partition into blocks of one pivot and vector length."""
    number = TaskContext.get().partitionId() << 32
    held: list[tuple] = []
    schema = pa.schema(
        [("block", pa.int64()), ("size", pa.int32()), ("pivot", pa.int32()), ("low", pa.float64()),
         ("high", pa.float64()), ("ids", pa.list_(pa.int64())), ("data", pa.binary())]
    )

    def block() -> pa.RecordBatch:
        nonlocal number, held
        size, pivot, low, _, _ = held[0]
        row = {
            "block": [number], "size": [size], "pivot": [pivot], "low": [low], "high": [held[-1][2]],
            "ids": [[x[3] for x in held]], "data": [b"".join(x[4] for x in held)],
        }
        number, held = number + 1, []
        return pa.RecordBatch.from_pydict(row, schema=schema)

    for batch in batches:
        columns = (batch.column(n).to_pylist() for n in ("size", "pivot", "distance", "id", "data"))
        for row in zip(*columns, strict=True):
            if held and (len(held) == BLOCK or held[0][:2] != row[:2]):
                yield block()
            held.append(row)
    if held:
        yield block()


def _best(k: int):
    """Each query's k best scores in one block, not counting the query's own row."""

    def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
        most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
        if most < EXACT:
            return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
        return q @ x.T

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                ids = np.asarray(row.ids)
                x = np.frombuffer(row.data, np.int64).reshape(len(ids), -1)
                queries = np.array([q["id"] for q in row.queries])
                found = scores(_matrix([q["data"] for q in row.queries]), x)
                floor = np.array([q["floor"] if q["floor"] is not None else np.iinfo(np.int64).min
                                  for q in row.queries])
                wanted = (found >= floor[:, None]) & (ids[None, :] != queries[:, None])
                out = []
                for n in range(len(queries)):
                    at = np.flatnonzero(wanted[n])
                    at = at[np.lexsort((ids[at], -found[n, at]))][:k]
                    out.append(pd.DataFrame({"query_id": queries[n], "vec_id": ids[at], "score": found[n, at]}))
                yield pd.concat(out)

    return run


def top_k(
    vectors: DataFrame,
    id_column: str,
    vector_column: str,
    is_query: Column,
    k: int = 10,
) -> DataFrame:
    """The ``k`` best rows for each query row: query_id, rank, vec_id, score.

    Vectors are taken as floor(1024 * x), scores are integer inner products, ties go to
    the smaller id, and a query's own row is no candidate; a query with fewer candidates
    gets all. ``is_query`` is a condition on ``id_column`` and marks the queries among
    all rows. Null or empty vectors and such with null or non-finite components take no
    part; vectors meet only those of their own length. Ids should be unique: rows that
    repeat a query's id are never its candidates. Other columns are not read; an empty
    table, or one without queries, gives no rows.

    The index is written to the shared folder. Pivots come from a bounded sample, every
    row is indexed and the bounds are exact, so the sample decides about time only.
    """
    whole = written(whole_vectors(vectors, id_column, vector_column), "whole-vectors")
    greatest2 = whole.agg(F.max("length2")).first()[0] or 0.0
    pivots = choose_pivots(whole)

    order = ["size", "pivot", "distance", "id"]
    placed = _placed(whole, pivots, greatest2, query=False)
    index = written(
        placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks, _BLOCK_COLUMNS),
        "pivot-index",
    )
    marked = whole.withColumnRenamed("id", id_column).where(is_query).withColumnRenamed(id_column, "id")
    queries = written(_placed(marked, pivots, greatest2, query=True), "pivot-queries")
    groups = max(1, -(-queries.count() // QUERY_BLOCK))

    # The least distance an annulus leaves, for every query and annulus of its length.
    annuli = index.select("block", "size", "pivot", "low", "high", F.size("ids").alias("rows"))
    reach = queries.select(
        F.col("id").alias("query_id"), "size", "length2",
        F.posexplode("distances").alias("pivot", "distance"),
    ).join(annuli, ["size", "pivot"])
    nearest = F.greatest(F.col("low") - F.col("distance"), F.col("distance") - F.col("high"), F.lit(0.0))
    slack = SLACK * (F.col("distance") + F.col("high") + 1)
    bounds = reach.select(
        "query_id", "length2", "block", F.greatest(nearest - slack, F.lit(0.0)).alias("nearest")
    )

    def searched(pairs: DataFrame) -> DataFrame:
        """Best rows of the (query_id, block, floor) given, a block meeting many queries at once."""
        wanted = pairs.join(queries.select(F.col("id").alias("query_id"), "data"), "query_id")
        met = wanted.groupBy(
            "block", F.pmod(F.xxhash64("query_id"), F.lit(groups)).alias("group")
        ).agg(
            F.collect_list(F.struct(F.col("query_id").alias("id"), "data", "floor")).alias("queries")
        )
        return index.select("block", "ids", "data").join(met, "block").mapInPandas(
            _best(k), "query_id long, vec_id long, score long"
        )

    by_nearness = Window.partitionBy("query_id").orderBy("nearest", "block")
    first = (
        bounds.withColumn("place", F.row_number().over(by_nearness))
        .where(F.col("place") <= NEAREST)
        .select("query_id", "block", F.lit(None).cast("long").alias("floor"))
    )
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)

    begun = written(best(searched(first)), "first-best")
    floors = begun.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    # An inner product in the annulus is (|q|^2 + M^2 - distance^2) / 2 at most.
    most = (F.col("length2") + F.lit(greatest2) - F.col("nearest") * F.col("nearest")) / 2
    slack = SLACK * (F.col("length2") + F.lit(greatest2) + 1)
    rest = (
        bounds.join(floors, "query_id", "left")
        .where(F.col("floor").isNull() | (most + slack >= F.col("floor")))
        .join(first.select("query_id", "block"), ["query_id", "block"], "left_anti")
        .select("query_id", "block", "floor")
    )
    found = searched(rest).union(begun.select("query_id", "vec_id", "score"))
    return best(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
