"""Edit distance of word sequences by banded alignment."""

from __future__ import annotations

import numpy as np

Pair = tuple[np.ndarray, np.ndarray]
# Cells of the alignment table that are worked on at a time.
CELLS = 1 << 15
# Counts of a bin that are compared exactly.
_LEVELS = 3


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common start."""
    n = min(len(a), len(b))
    differs = np.flatnonzero(a[:n] != b[:n])
    return int(differs[0]) if len(differs) else n


def _in_band(pairs: list[Pair], band: int) -> list[int | None]:
    """Each pair's distance if it is at most ``band``; then no alignment leaves so many diagonals.

    All pairs advance by one word of their first text at a time, so a step of the table
    is a few operations on an array of pairs by diagonals.
    """
    size = 2 * band + 1
    rows = max(len(a) for a, _ in pairs)
    far = np.int32(1 << 28)
    offsets = np.arange(size, dtype=np.int32)
    first = np.full((len(pairs), rows), -1, np.int64)
    second = np.full((len(pairs), rows + 3 * band + 1), -2, np.int64)
    for n, (a, b) in enumerate(pairs):
        first[n, : len(a)] = a.view(np.int64)
        kept = b[: second.shape[1] - band].view(np.int64)
        second[n, band : band + len(kept)] = kept
    ends: dict[int, list[int]] = {}
    for n, (a, _) in enumerate(pairs):
        ends.setdefault(len(a), []).append(n)
    found: list[int | None] = [None] * len(pairs)
    # Cell d of a row stands for column row + d - band. Columns behind the second text's end
    # never lead back before it.
    row = np.tile(np.where(offsets >= band, offsets - band, far).astype(np.int32), (len(pairs), 1))
    for i in range(1, rows + 1):
        step = row + (second[:, i - 1 : i - 1 + size] != first[:, i - 1, None])
        np.minimum(step[:, :-1], row[:, 1:] + 1, out=step[:, :-1])
        if i <= band:
            step[:, : band - i] = far
            step[:, band - i] = i
        step -= offsets
        row = np.minimum.accumulate(step, axis=1) + offsets
        for n in ends.get(i, ()):
            a, b = pairs[n]
            distance = int(row[n, len(b) - len(a) + band])
            found[n] = distance if distance <= band else None
        if i % 64 == 0 and row.min() > band:
            break
    return found


def _trimmed(a: np.ndarray, b: np.ndarray) -> Pair:
    """The two without their common start and end."""
    start = _common(a, b)
    a, b = a[start:], b[start:]
    end = _common(a[::-1], b[::-1])
    return a[: len(a) - end], b[: len(b) - end]


def edits_within(pairs: list[Pair], limits: list[int], expected: list[int]) -> list[int | None]:
    """Word edits between the texts of each pair, None where more than the limit.

    Texts are 64-bit hashes of words. Each pair's band is widened until it holds the
    distance, from ``expected`` on, so near copies take a narrow one.
    """
    found: list[int | None] = [None] * len(pairs)
    bands: dict[int, list[int]] = {}
    trimmed = [_trimmed(a, b) for a, b in pairs]
    for n, (a, b) in enumerate(trimmed):
        apart = abs(len(a) - len(b))
        if apart > limits[n]:
            continue
        if not len(a) or not len(b):
            found[n] = max(len(a), len(b))
        else:
            bands.setdefault(_band(max(expected[n], apart)), []).append(n)
    while bands:
        band = min(bands)
        # Texts of about one length go together, as many as keep the table small.
        waiting = sorted(bands.pop(band), key=lambda n: len(trimmed[n][0]))
        while waiting:
            longest = len(trimmed[waiting[-1]][0]) + 2 * band
            together = max(1, min(CELLS // (2 * band + 1), 8 * CELLS // longest))
            part, waiting = waiting[-together:], waiting[:-together]
            for n, distance in zip(part, _in_band([trimmed[n] for n in part], band), strict=True):
                if distance is not None:
                    found[n] = distance if distance <= limits[n] else None
                elif band < limits[n]:
                    bands.setdefault(2 * band, []).append(n)
    return found


def _band(least: int) -> int:
    """The band of at least so many diagonals on each side: 8, 16, 32 and so on."""
    return max(8, 1 << (least - 1).bit_length())


def shared_words(a: np.ndarray, b: np.ndarray) -> int:
    """Words two sequences have in common, counted as often as in both."""
    (x, n), (y, m) = (np.unique(words, return_counts=True) for words in (a, b))
    _, at, on = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return int(np.minimum(n[at], m[on]).sum())


def similar(pairs: list[Pair], similarity: float) -> list[bool]:
    """Whether 1 - edits / words of the longer text is at least ``similarity``, for each pair."""
    asked, limits, expected = [], [], []
    for n, (a, b) in enumerate(pairs):
        longer = max(len(a), len(b))
        limit = int((1 - similarity) * longer + 1e-9)
        if not longer or longer - min(len(a), len(b)) > limit:
            continue
        # Every word of the longer one that the other lacks takes an edit.
        least = longer - shared_words(a, b)
        if least <= limit:
            asked.append(n)
            limits.append(limit)
            expected.append(least + least // 4 + 2)
    alike = [False] * len(pairs)
    found = edits_within([pairs[n] for n in asked], limits, expected)
    for n, distance in zip(asked, found, strict=True):
        alike[n] = distance is not None
    return alike


def may_be_similar(texts: list[np.ndarray], similarity: float, bins: int = 1024) -> np.ndarray:
    """For every two texts, whether they may have enough words in common to be similar.

    Words are counted by a hash. Two texts share at most the smaller count of every bin;
    counts up to ``_LEVELS`` are written as so many ones, so a matrix product sums the smaller
    ones, and what is above that is taken as shared.
    """
    sizes = np.array([len(text) for text in texts], np.float64)
    counts = np.array([np.bincount(text % np.uint64(bins), minlength=bins) for text in texts])
    ones = (counts[:, :, None] > np.arange(_LEVELS)).reshape(len(texts), -1).astype(np.float32)
    above = np.maximum(0, counts - _LEVELS).sum(axis=1)
    shared = ones @ ones.T + np.minimum(above[:, None], above[None, :])
    longer = np.maximum(sizes[:, None], sizes[None, :])
    shorter = np.minimum(sizes[:, None], sizes[None, :])
    least = similarity * longer - 1e-6
    return (shared >= least) & (shorter >= least)

