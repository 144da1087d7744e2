"""Whitening of embeddings by an incremental eigendecomposition.

Every partition keeps the spectrum of its own scatter matrix (eigenvectors, eigenvalues,
mean, count) and brings it up to date by centred rank-one updates: the new eigenvalues
are the roots of the secular equation, solved between the old ones after deflation, the
new eigenvectors follow from them. The rows of a batch are first rotated (QR) into at
most as many rows as there are dimensions; the sum of rank-one terms stays the same, so a
batch takes that many updates however many rows it has. The partitions' spectra are
combined, a bounded number in a task and in rounds, by one rank-one update for each
eigenpair and one for the difference of the means. What rounding has left is taken out by
a last Rayleigh-Ritz step, whose matrix is summed over the partitions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import checkpointed
from bazaarlake.session import written

# Entries become floor(SCALE * c) + SHIFT; beyond HELD they are held there.
SCALE, SHIFT = 64, 1_000_000
HELD = float(1 << 61)
COMPONENTS = 16
# Spectra or matrices that one task combines.
FAN_IN = 16
# Halvings of an interval in which a root of the secular equation lies.
HALVINGS = 64
EPS = float(np.finfo(np.float64).eps)

RESULTS = ("component", "n", "deviation", "whitened", "explained", "identity_error")


# -- one spectrum ----------------------------------------------------------------------


def _deflated(d: np.ndarray, z: np.ndarray, u: np.ndarray, tolerance: float) -> np.ndarray:
    """Which poles the update moves; changes ``z`` and ``u`` in place.

    A pole without weight stays. Of two equal poles, one gives its weight to the other
    by a rotation and stays.
    """
    moves = np.abs(z) > tolerance
    last = -1
    for i in np.flatnonzero(moves):
        if last >= 0:
            length = math.hypot(z[last], z[i])
            c, s = z[i] / length, z[last] / length
            if abs((d[i] - d[last]) * c * s) <= tolerance:
                a, b = u[:, last].copy(), u[:, i].copy()
                u[:, last], u[:, i] = c * a - s * b, s * a + c * b
                z[last], z[i] = 0.0, length
                moves[last] = False
        last = i
    return moves


def _secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z**2 / (d - x)), as the nearer pole's index and the way from it.

    ``d`` rises strictly and no weight is zero, so one root lies in each gap between two
    poles and one behind the last, at most ``z @ z`` away.
    """
    k, weight = len(d), z * z
    gap = np.append(np.diff(d), z @ z)
    middle = d + gap / 2
    with np.errstate(divide="ignore", over="ignore"):
        at_middle = 1 + (weight / (d - middle[:, None])).sum(axis=1)
        nearer_next = (at_middle < 0) & (np.arange(k) < k - 1)
        origin = np.arange(k) + nearer_next
        low = np.where(nearer_next, -gap / 2, 0.0)
        high = np.where(nearer_next, 0.0, gap / 2)
        high[-1] = gap[-1] * (1 + 4 * EPS)
        from_origin = d - d[origin][:, None]
        for _ in range(HALVINGS):
            way = (low + high) / 2
            below = 1 + (weight / (from_origin - way[:, None])).sum(axis=1) < 0
            low, high = np.where(below, way, low), np.where(below, high, way)
    way = (low + high) / 2
    # Never on the pole itself: an interval that is too short to halve ends beside it.
    way[way == 0] = np.where(nearer_next, -1.0, 1.0)[way == 0] * np.finfo(np.float64).tiny
    return origin, way


def rank_one_update(values: np.ndarray, vectors: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) of ``V diag(values) V' + x x'``."""
    z = vectors.T @ x
    size = float(z @ z)
    scale = max(float(np.abs(values).max(initial=0.0)), size)
    if size == 0 or not math.isfinite(size):
        return values, vectors
    order = np.argsort(values, kind="stable")
    d, z, u = values[order].copy(), z[order].copy(), vectors[:, order].copy()
    moves = _deflated(d, z, u, 8 * EPS * math.sqrt(scale) * math.sqrt(scale / size))
    at = np.flatnonzero(moves)
    if len(at) == 0:
        return d, u
    poles, weights = d[at], z[at]
    origin, way = _secular_roots(poles, weights)
    # away[j, i]: root j minus pole i, without cancellation.
    away = (poles[origin][:, None] - poles) + way[:, None]
    # The weights for which these roots are exact make the eigenvectors orthogonal.
    k = len(at)
    apart = poles - poles[:, None]  # [i, j]: pole j minus pole i
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = away.T / np.where(np.eye(k, dtype=bool), 1.0, apart)
    exact = np.sqrt(np.abs(ratio.prod(axis=1)))
    q = np.copysign(exact, weights) / away  # [j, i]
    q /= np.sqrt((q * q).sum(axis=1, keepdims=True))
    d[at] = poles[origin] + way
    u[:, at] = u[:, at] @ q.T
    return d, u


@dataclass
class Spectrum:
    """Eigendecomposition of a scatter matrix about the mean of ``n`` vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size), np.zeros(size), np.eye(size))

    def add(self, n: int, mean: np.ndarray, terms: np.ndarray) -> None:
        """Take in ``n`` more vectors: their mean and their scatter's rank-one terms (rows)."""
        for term in terms:
            self.values, self.vectors = rank_one_update(self.values, self.vectors, term)
        if self.n:
            apart = (mean - self.mean) * math.sqrt(self.n * n / (self.n + n))
            self.values, self.vectors = rank_one_update(self.values, self.vectors, apart)
        self.mean = self.mean + (mean - self.mean) * (n / (self.n + n))
        self.n += n

    def add_rows(self, x: np.ndarray) -> None:
        mean = x.mean(axis=0)
        centred = x - mean
        if len(x) > x.shape[1]:
            centred = np.linalg.qr(centred, mode="r")
        self.add(len(x), mean, centred)

    def combine(self, other: Spectrum) -> None:
        roots = np.sqrt(np.maximum(other.values, 0))
        self.add(other.n, other.mean, (other.vectors * roots).T)


# -- vectors as bytes ------------------------------------------------------------------


def whole_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each vector length: the rows that take part, and floor(SCALE * c) of theirs."""
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        flat = column.take(pa.array(rows)).flatten().cast(pa.float64())
        x = flat.fill_null(math.nan).to_numpy(zero_copy_only=False).reshape(len(rows), size)
        finite = np.isfinite(x).all(axis=1)
        with np.errstate(over="ignore"):
            y = np.clip(np.floor(SCALE * x[finite]), -HELD, HELD).astype(np.int64)
        yield rows[finite], y


def _bytes(y: np.ndarray) -> list[bytes]:
    """Each row by its own range in 2, 4 or 8 bytes an entry, so equal rows are equal bytes."""
    out = []
    largest = np.maximum(y.max(axis=1), -(y.min(axis=1) + 1))
    for row, most in zip(y, largest, strict=True):
        width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
        out.append(bytes([width]) + row.astype(f"<i{width}").tobytes())
    return out


def _of_bytes(cells: list[bytes]) -> Iterator[np.ndarray]:
    """Matrices of the rows in ``cells``, one for each vector length."""
    rows = {}
    for cell in cells:
        rows.setdefault((cell[0], len(cell)), []).append(cell[1:])
    by_size: dict[int, list[np.ndarray]] = {}
    for (width, _), group in rows.items():
        y = np.frombuffer(b"".join(group), f"<i{width}").reshape(len(group), -1)
        by_size.setdefault(y.shape[1], []).append(y.astype(np.int64))
    for parts in by_size.values():
        yield np.concatenate(parts)


def fit_list(vectors: DataFrame) -> DataFrame:
    """Each distinct vector once, as ``data``; ``vectors`` holds them as ``vector``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [c for _, y in whole_vectors(batch.column("vector")) for c in _bytes(y)]
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.binary())], ["data"])

    return written(vectors.select("vector").mapInArrow(run, "data binary").distinct(), "fit-list")


# -- sums over partitions --------------------------------------------------------------


def _in_rounds(parts: DataFrame, combine: Callable[[pd.DataFrame], pd.DataFrame]) -> pd.DataFrame:
    """One row for each ``size``: rows of a size are combined, ``FAN_IN`` at a time."""
    schema = parts.schema
    parts = checkpointed(parts.withColumn("part", F.monotonically_increasing_id()))
    while True:
        most = parts.groupBy("size").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return parts.drop("part").toPandas()
        groups = math.ceil(most / FAN_IN)
        parts = checkpointed(
            parts.withColumn("group", F.pmod(F.xxhash64("part"), F.lit(groups)))
            .groupBy("size", "group")
            .applyInPandas(lambda df: combine(df.sort_values("part").drop(columns=["part", "group"])), schema)
            .withColumn("part", F.monotonically_increasing_id())
        )


_SPECTRUM = "size int, n long, sums array<decimal(38,0)>, mean array<double>, spectrum_values array<double>, vectors array<double>"


def _spectrum_row(size: int, sums: list[int], s: Spectrum) -> dict:
    return {
        "size": size, "n": s.n, "sums": [Decimal(v) for v in sums], "mean": s.mean.tolist(),
        "spectrum_values": s.values.tolist(), "vectors": s.vectors.ravel().tolist(),
    }


def _spectrum_of(row: pd.Series) -> Spectrum:
    size = int(row["size"])
    return Spectrum(
        int(row["n"]),
        np.array(row["mean"], float),
        np.array(row["spectrum_values"], float),
        np.array(row["vectors"], float).reshape(size, size),
    )


def _exact_sums(y: np.ndarray) -> list[int]:
    """Column sums as whole numbers of any size."""
    high, low = y >> 31, y & ((1 << 31) - 1)
    return [(int(h) << 31) + int(v) for h, v in zip(high.sum(axis=0), low.sum(axis=0), strict=True)]


def _partition_spectra(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    spectra: dict[int, Spectrum] = {}
    sums: dict[int, list[int]] = {}
    for batch in batches:
        for y in _of_bytes(batch["data"].to_list()):
            size = y.shape[1]
            spectra.setdefault(size, Spectrum.empty(size)).add_rows(y.astype(np.float64))
            sums[size] = [a + b for a, b in zip(sums.get(size, [0] * size), _exact_sums(y), strict=True)]
    if spectra:
        yield pd.DataFrame([_spectrum_row(size, sums[size], s) for size, s in spectra.items()])


def _combined_spectra(rows: pd.DataFrame) -> pd.DataFrame:
    first, *others = [row for _, row in rows.iterrows()]
    spectrum, sums = _spectrum_of(first), [int(v) for v in first["sums"]]
    for row in others:
        spectrum.combine(_spectrum_of(row))
        sums = [a + int(b) for a, b in zip(sums, row["sums"], strict=True)]
    return pd.DataFrame([_spectrum_row(int(first["size"]), sums, spectrum)])


@dataclass
class Whitening:
    """What is fitted to the vectors of one length; components are columns."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float = 0.0
    identity_error: float = 0.0

    def centred(self, y: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums])
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (y - whole).astype(np.float64) - rest

    def projected(self, y: np.ndarray) -> np.ndarray:
        return self.centred(y) @ self.components

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return self.projected(y) / np.sqrt(self.values)

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """sum((n * x - S) ** 2) of each row, exactly; None where it is beyond a long."""
        most = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.sums), default=0)
        if most < 1 << 31 and y.shape[1] * most**2 < 1 << 63:
            apart = self.n * y - np.array(self.sums)
            return (apart * apart).sum(axis=1).tolist()
        exact = [sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in y]
        return [value if value < 1 << 63 else None for value in exact]


def _covariance_sums(fitted: dict[int, Whitening], project: Callable[[Whitening, np.ndarray], np.ndarray]):
    """Of each length, the sum over a partition of the projected rows' outer products."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for y in _of_bytes(batch["data"].to_list()):
                p = project(fitted[y.shape[1]], y)
                sums[y.shape[1]] = sums.get(y.shape[1], 0.0) + p.T @ p
        if sums:
            yield pd.DataFrame({"size": list(sums), "products": [m.ravel().tolist() for m in sums.values()]})

    return run


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.array(cell, float) for cell in rows["products"]], axis=0)
    return pd.DataFrame({"size": [rows["size"].iloc[0]], "products": [total.tolist()]})


def _covariances(
    fits: DataFrame, fitted: dict[int, Whitening], project: Callable[[Whitening, np.ndarray], np.ndarray]
) -> Iterator[tuple[Whitening, np.ndarray]]:
    parts = fits.mapInPandas(_covariance_sums(fitted, project), "size int, products array<double>")
    for row in _in_rounds(parts, _added).itertuples():
        model = fitted[int(row.size)]
        sums = np.array(row.products, float)
        side = math.isqrt(len(sums))
        yield model, sums.reshape(side, side) / model.n


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """A whitening for each length of the vectors in the column ``vector``.

    The driver gets one spectrum and two matrices for each length, never rows.
    """
    fits = fit_list(vectors)
    spectra = _in_rounds(fits.mapInPandas(_partition_spectra, _SPECTRUM), _combined_spectra)
    fitted = {}
    for _, row in spectra.iterrows():
        spectrum = _spectrum_of(row)
        basis = np.linalg.qr(spectrum.vectors)[0]
        fitted[int(row["size"])] = Whitening(
            spectrum.n, [int(v) for v in row["sums"]], basis, spectrum.values
        )
    for model, covariance in _covariances(fits, fitted, Whitening.projected):
        values, rotation = np.linalg.eigh((covariance + covariance.T) / 2)
        model.trace = float(values.sum())
        leading = np.argsort(-values, kind="stable")[:components]
        # No variance to rounding: nothing to divide by.
        leading = leading[values[leading] > 64 * len(values) * EPS * max(values.max(), 0)]
        model.values = values[leading]
        model.components = model.components @ rotation[:, leading]
        largest = np.abs(model.components).argmax(axis=0)
        model.components *= np.sign(model.components[largest, np.arange(len(leading))])
    for model, covariance in _covariances(fits, fitted, Whitening.whitened):
        model.identity_error = float(np.abs(covariance - np.eye(len(covariance))).max(initial=0))
    return fitted


def whiten(
    vectors: DataFrame, id_column: str, vector_column: str, components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component: the vector whitened along the component.

    Entries c count as x = floor(64 * c) + 1000000. The fit takes each distinct x once:
    ``n`` vectors with sums S and covariance V (divisor n). ``component`` numbers V's unit
    eigenvectors from 1 by falling eigenvalue e, the largest entry of each positive, up to
    ``components``. ``whitened`` is x - S / n along the component, over sqrt(e),
    ``explained`` is e / trace(V), ``deviation`` the exact sum of (n * x - S) ** 2 (null
    beyond a long), ``identity_error`` the largest absolute entry of the fit list's
    whitened covariance minus the identity.

    Vectors that are null or hold null or non-finite entries are left out. Vectors of
    different lengths are fitted apart. A component without variance has no rows, so a
    length with one distinct vector has none, nor have empty vectors or an empty table.
    Rows of one id, or without one, are rows of their own. Entries beyond 2^61 / 64 are
    held there. Other columns are not read; an id named like a result is refused.

    An update takes d^3 steps and a batch d of them, so this is for hundreds of dimensions.
    """
    if id_column.lower() in RESULTS:
        raise ValueError(f"the id column is named like a result: {id_column}")
    named = vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector_column}`").alias("vector"))
    fitted = fit(named, components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, y in whole_vectors(batch.column("vector")):
                if not len(rows):
                    continue
                model = fitted[y.shape[1]]
                k = len(model.values)
                n = len(rows) * k
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(np.repeat(rows, k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(n, model.n, np.int64)),
                        pa.array(model.deviations(y), pa.int64()).take(
                            pa.array(np.repeat(np.arange(len(rows)), k))
                        ),
                        pa.array(model.whitened(y).ravel()),
                        pa.array(np.tile(model.values / model.trace, len(rows))),
                        pa.array(np.full(n, model.identity_error)),
                    ],
                    ["id", *RESULTS],
                )

    kind = named.schema["id"].dataType.simpleString()
    return named.mapInArrow(
        run,
        f"id {kind}, component int, n long, deviation long, whitened double,"
        " explained double, identity_error double",
    ).withColumnRenamed("id", id_column)
