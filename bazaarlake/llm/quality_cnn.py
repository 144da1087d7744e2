"""Quality of a text by a byte-level convolutional network, in numpy.

The network slides learned filters of a few bytes over the text. A filter's value at a
position is a sum of one learned weight per byte and place, so it is looked up, not
multiplied. Beside the bytes the input has planes that tell where a byte equals the
one some places before; their longest agreement shows words said again and again, which
no fixed bytes can. Both are max-pooled over chunks of 512 bytes that overlap by half
and together cover the whole text; the chunks' mean goes through a logistic unit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import text_slices, texts_of

WIDTH = 6
FILTERS = 12
BLOCK = 256  # half a chunk
LAGS = 32
UNIT = 32  # bytes over which agreement with earlier bytes is measured
# The classifier is fitted to at most so many labelled rows, half of each label, and to
# at most so many chunks of each, spread over its text.
SAMPLE_ROWS = 2000
SAMPLE_CHUNKS = 4
CHUNK = 2 * BLOCK
STEPS = 300
BATCH = 50
# Bytes scored at a time.
SEGMENT = 1 << 19


@dataclass
class Network:
    table: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray
    weights: np.ndarray  # FILTERS, and one for agreement
    offset: float

    def score(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(pooled @ self.weights + self.offset)))


def lay_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts in whole blocks behind each other, which bytes are text, blocks per text.

    At least LAGS empty bytes follow each text, so nothing reaches across two of them.
    """
    blocks = np.array([(len(text) + LAGS) // BLOCK + 1 for text in texts])
    data = np.zeros(int(blocks.sum()) * BLOCK, np.uint8)
    real = np.zeros(len(data), bool)
    start = 0
    for text, count in zip(texts, blocks, strict=True):
        data[start : start + len(text)] = np.frombuffer(text, np.uint8)
        real[start : start + len(text)] = True
        start += int(count) * BLOCK
    return data, real, blocks


def agreement(data: np.ndarray, real: np.ndarray) -> np.ndarray:
    """Per block, the largest share of a unit's bytes that repeat at one distance, from 0.5 on."""
    best = np.zeros(len(data) // UNIT, np.uint8)
    for lag in range(1, LAGS + 1):
        same = real.copy()
        same[lag:] &= data[lag:] == data[:-lag]
        same[:lag] = False
        np.maximum(best, np.bitwise_count(np.packbits(same).view(np.uint32)), out=best)
    share = best.reshape(-1, BLOCK // UNIT).max(axis=1) / UNIT
    return np.maximum(0.0, 2 * share - 1)


def convolved(network: Network, data: np.ndarray, real: np.ndarray) -> np.ndarray:
    """Per block, the largest value of each filter over its positions, at least 0."""
    blocks = np.empty((len(data) // BLOCK, FILTERS), np.float32)
    for start in range(0, len(data), SEGMENT):
        end = min(start + SEGMENT, len(data))
        part = data[start : end + WIDTH - 1]
        part = np.pad(part, (0, end - start + WIDTH - 1 - len(part)))
        values = network.table[0][part[: end - start]]
        for place in range(1, WIDTH):
            values += network.table[place][part[place : place + end - start]]
        values[~real[start:end]] = -np.inf
        pooled = values.reshape(-1, BLOCK, FILTERS).max(axis=1)
        blocks[start // BLOCK : end // BLOCK] = np.maximum(0, pooled + network.bias)
    return blocks


def score_texts(network: Network, texts: list[bytes]) -> np.ndarray:
    """Probability of quality 1 for each whole text."""
    if not texts:
        return np.zeros(0)
    data, real, counts = lay_out(texts)
    values = np.column_stack([convolved(network, data, real), agreement(data, real)])
    starts = np.concatenate([[0], counts.cumsum()[:-1]])
    # A chunk is a block and the next one of the same text.
    chunks = values.copy()
    np.maximum(chunks[:-1], values[1:], out=chunks[:-1])
    last = starts + counts - 1
    chunks[last] = np.where((counts == 1)[:, None], values[last], 0)
    sums = np.add.reduceat(chunks, starts, axis=0)
    return network.score(sums / np.maximum(1, counts - 1)[:, None])


def fit(chunks: list[list[bytes]], labels: list[int], seed: int = 7) -> Network:
    """The network that tells apart the labelled documents, given by their chunks.

    Gradients of the log loss are followed through the positions the maxima came from,
    with Adam's step sizes. With documents of one label only, every score is near it; without any it is 0.5.
    """
    rng = np.random.default_rng(seed)
    network = Network(
        rng.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.1, FILTERS + 1),
        0.0,
    )
    if len(set(labels)) < 2:
        network.weights[:] = 0
        network.offset = {(): 0.0, (0,): -4.0, (1,): 4.0}[tuple(set(labels))]
        return network
    rows = [np.zeros((len(parts), CHUNK), np.uint8) for parts in chunks]
    repeats = []
    for parts, row in zip(chunks, rows, strict=True):
        for part, place in zip(parts, row, strict=True):
            place[: min(len(part), CHUNK)] = np.frombuffer(part[:CHUNK], np.uint8)
        data, real, counts = lay_out(parts)
        starts = np.concatenate([[0], counts.cumsum()[:-1]])
        repeats.append(np.maximum.reduceat(agreement(data, real), starts).mean())
    target = np.array(labels, float)
    parameters = [network.table, network.bias, network.weights, np.zeros(1)]
    moments = [(np.zeros_like(p, dtype=float), np.zeros_like(p, dtype=float)) for p in parameters]
    positions = CHUNK - WIDTH + 1
    step = 0
    while step < STEPS:
        order = rng.permutation(len(rows))
        for begin in range(0, len(order), BATCH):
            batch = order[begin : begin + BATCH]
            data = np.concatenate([rows[i] for i in batch])
            owner = np.repeat(np.arange(len(batch)), [len(rows[i]) for i in batch])
            size = np.bincount(owner, minlength=len(batch))
            values = network.table[0][data[:, :positions]]
            for place in range(1, WIDTH):
                values += network.table[place][data[:, place : place + positions]]
            at = values.argmax(axis=1)
            top = np.take_along_axis(values, at[:, None, :], axis=1)[:, 0] + network.bias
            active = np.maximum(0, top)
            pooled = np.zeros((len(batch), FILTERS + 1))
            np.add.at(pooled[:, :FILTERS], owner, active)
            pooled[:, :FILTERS] /= size[:, None]
            pooled[:, FILTERS] = [repeats[i] for i in batch]
            offset = parameters[3]
            scored = 1 / (1 + np.exp(-(pooled @ network.weights + offset)))
            error = (scored - target[batch]) / len(batch)
            back = error[owner, None] * network.weights[:FILTERS] / size[owner, None] * (top > 0)
            slope = np.zeros(network.table.shape)
            for place in range(WIDTH):
                seen = np.take_along_axis(data, at + place, axis=1)
                np.add.at(slope[place], (seen, np.arange(FILTERS)), back)
            slopes = [
                slope + 1e-5 * network.table,
                back.sum(axis=0),
                error @ pooled + 1e-4 * network.weights,
                np.array([error.sum()]),
            ]
            step += 1
            for parameter, (mean, square), gradient in zip(parameters, moments, slopes, strict=True):
                mean += 0.1 * (gradient - mean)
                square += 0.001 * (gradient * gradient - square)
                rate = 0.02 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                parameter -= (rate * mean / (np.sqrt(square) + 1e-8)).astype(parameter.dtype)
    network.offset = float(parameters[3][0])
    return network


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Network:
    """A network fitted to at most ``rows`` labelled documents that aren't held out.

    The sample is chosen by a hash, half of it from each label as far as there are so
    many. Only ``SAMPLE_CHUNKS`` chunks of each document reach the driver, so what it
    holds is bounded however long the texts are. Rows whose label is not 0 or 1, or whose
    id or label is null, are left out.
    """
    shuffled = F.xxhash64(F.col("doc_id"), F.lit(11))
    usable = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    usable = usable.select("doc_id", F.col("quality").cast("int").alias("quality"))
    chosen = None
    for label in (0, 1):
        part = usable.where(F.col("quality") == label).distinct()
        part = part.orderBy(shuffled, "doc_id").limit(rows // 2)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most ``rows`` ids and labels: small enough for every executor.
    known = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )
    room = F.greatest(F.lit(0), F.length("text") - CHUNK)
    places = F.array_distinct(
        F.transform(
            F.sequence(F.lit(0), F.lit(SAMPLE_CHUNKS - 1)),
            lambda i: F.floor(room * i / (SAMPLE_CHUNKS - 1)).cast("int"),
        )
    )
    parts = F.transform(places, lambda at: F.substr("text", at + 1, F.lit(CHUNK)))
    # Repeated rows count once.
    sample = (
        known.select("doc_id", "quality", parts.alias("parts"))
        .orderBy(shuffled, "doc_id", "quality", "parts")
        .limit(rows)
        .collect()
    )
    return fit([[p.encode() for p in r.parts] for r in sample], [r.quality for r in sample])


def classify(docs: DataFrame, network: Network, columns: list[str], keep: bool = False) -> DataFrame:
    """``columns`` of every document with its ``score`` for quality 1.

    With ``keep`` the whole row stays and only documents with a score of at least 0.5.
    A null text counts as empty and is scored like an empty one; texts are scored whole,
    however long. Repeated rows get equal scores. An empty table gives no rows.
    """
    kept = docs if keep else docs.select(*columns, "text")
    names = kept.columns if keep else columns
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            texts = [text.encode() for text in texts_of(batch.column("text"))]
            scores = score_texts(network, texts)
            if keep:
                yield batch.filter(pa.array(scores >= 0.5))
            else:
                arrays = [*(batch.column(name) for name in names), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(arrays, [*names, "score"])

    return kept.mapInArrow(run, ", ".join(fields if keep else [*fields, "score double"]))
