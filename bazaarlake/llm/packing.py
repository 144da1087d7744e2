"""Order-preserving packing of documents into fixed training windows.

The documents of a partition, in its order, are one stream of tokens. Windows are cut
from it so that padding plus the penalties of cut documents are smallest: a cut costs
nothing between documents, a little behind a sentence, and more between two words of a
sentence, where boundaries are offered every few tokens. With ``best[j]`` the least cost of all
windows up to boundary ``j``,

    best[j] = penalty[j] + min over i of best[i] + window - (position[j] - position[i])

for boundaries ``i`` at most a window before ``j``. The inner term is ``best[i] +
position[i]`` and something that depends on ``j`` alone, so a queue that is kept
monotone yields the minimum in constant time.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from functools import cache
from struct import Struct
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from bazaarlake.llm.common import text_slices, texts_of
from bazaarlake.llm.words import Chunker, Special, byte_alphabet

WINDOW = 4096
SENTENCE_CUT = 4.0
WORD_CUT = 12.0
INNER_CUT = 64.0  # inside a word
CUT_COSTS = np.array([0.0, WORD_CUT, SENTENCE_CUT])
# Boundaries between words are offered so many tokens apart.
WORD_CUT_EVERY = 24
# Windows decided at a time; the last one stays open until more documents are read.
SEGMENT_WINDOWS = 64
# Distinct chunks and words a Python worker remembers, over its tasks, before it forgets them all.
REMEMBERED_CHUNKS = 1_000_000
SENTENCE_ENDS = ".!?…。！？"
# How so many ids are written.
_WRITERS = [Struct(f"<{count}I").pack for count in range(64)]


class Document(NamedTuple):
    row: tuple
    ids: bytes  # little-endian unsigned 32-bit
    stops: np.ndarray  # tokens up to a place to cut, rising, ...
    costs: np.ndarray  # ... and what the cut costs

    @property
    def tokens(self) -> int:
        return len(self.ids) // 4


class ChunkIds(dict):
    """Token ids by chunk; each distinct chunk is encoded when met, until all are forgotten."""

    def __init__(self, path: str, remembered: int = REMEMBERED_CHUNKS) -> None:
        super().__init__()
        self.chunker = Chunker(path)
        self.remembered = remembered
        tokenizer = self.chunker.tokenizer
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        mark = tokenizer.model.end_of_word_suffix or ""
        ends = tuple(byte_alphabet(sign) + mark for sign in SENTENCE_ENDS)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_sentence = self.ends_word.copy()
        for token, number in vocabulary.items():
            self.ends_word[number] = token.endswith(mark)
            self.ends_sentence[number] = token.endswith(ends)
        self._tokenize = tokenizer.model.tokenize
        self._specials: dict[str | Special, bytes] = {}
        for special in self.chunker.specials.values():
            ids = _ids_written([special.token_id])
            self._specials |= {special: ids, special.name: ids}
        # Words that are not plain letters, in the byte alphabet.
        self._words: dict[str, bytes] = {}

    def __missing__(self, chunk: str | Special) -> bytes:
        ids = self._specials.get(chunk)
        if ids is None:
            if chunk.isascii() and chunk.isalpha():
                ids = self._tokenized(chunk)  # one word
            else:
                ids = b"".join([self._word(word) for word in self.chunker.pieces(chunk)])
        return self._kept(self, chunk, ids)

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self[word]  # as a chunk it is this one word
        known = self._words.get(word)
        return self._kept(self._words, word, self._tokenized(word)) if known is None else known

    def _kept(self, known: dict, key: str | Special, ids: bytes) -> bytes:
        if len(self) + len(self._words) >= self.remembered:
            self.clear()
            self._words.clear()
        known[key] = ids
        return ids

    def _tokenized(self, word: str) -> bytes:
        return _ids_written([token.id for token in self._tokenize(word)])


def _ids_written(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return _WRITERS[len(ids)](*ids) if len(ids) < len(_WRITERS) else np.array(ids, "<u4").tobytes()


@cache
def chunk_ids(path: str, remembered: int) -> ChunkIds:
    """One for all tasks of a worker, so a chunk met again in another partition is known."""
    return ChunkIds(path, remembered)


def document(row: tuple, chunks: list, encoder: ChunkIds, end: bytes) -> Document:
    named = [chunk if isinstance(chunk, str) else chunk.name for chunk in chunks]
    lists = pa.array([named], pa.list_(pa.large_string()))
    return documents([row], lists, encoder, end)[0]


def documents(
    rows: list[tuple], chunks: pa.ListArray, encoder: ChunkIds, end: bytes
) -> list[Document]:
    """One document per row and list of chunks."""
    ids = _joined(chunks, encoder)
    tokens = np.frombuffer(b"".join(ids), "<u4")
    ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)
    starts = np.concatenate([[0], ends[:-1]])
    kind = np.zeros(len(tokens) + 1, np.uint8)  # of cut, by the tokens up to it
    kind[_every(np.flatnonzero(encoder.ends_word[tokens]) + 1, starts, ends)] = 1
    kind[1:][encoder.ends_sentence[tokens]] = 2
    stops = np.flatnonzero(kind)
    costs = CUT_COSTS[kind[stops]]
    bounds = np.searchsorted(stops, [starts, ends], "right").T.tolist()
    return [
        Document(row, written + end, stops[first:last] - start, costs[first:last])
        for row, written, start, (first, last) in zip(rows, ids, starts, bounds, strict=True)
    ]


def _joined(chunks: pa.ListArray, encoder: ChunkIds) -> np.ndarray:
    """The ids of every list of chunks; each distinct chunk is looked up once."""
    coded = chunks.values.dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False)
    known = pa.array(list(map(encoder.__getitem__, distinct)), pa.large_binary())
    lists = pa.ListArray.from_arrays(chunks.offsets, known.take(coded.indices))
    joined = pc.binary_join(lists, pa.scalar(b"", pa.large_binary()))
    return joined.to_numpy(zero_copy_only=False)


def _every(reached: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first word end behind every WORD_CUT_EVERY tokens of a document."""
    counts = (ends - starts) // WORD_CUT_EVERY
    before = np.cumsum(counts) - counts
    nth = np.arange(1, counts.sum() + 1) - np.repeat(before, counts)
    goals = np.repeat(starts, counts) + WORD_CUT_EVERY * nth
    at = np.append(reached, ends[-1:] + 1)[np.searchsorted(reached, goals)]
    return at[at <= np.repeat(ends, counts)]


def boundaries(docs: list[Document], window: int) -> tuple[list[int], list[float]]:
    """Positions in the stream where a window may end, and what ending there costs.

    A document ends behind its last stop, so positions rise.
    """
    positions, costs = [np.zeros(1, np.int64)], [np.zeros(1)]
    start = 0
    for doc in docs:
        positions += [doc.stops + start, [start + doc.tokens]]
        costs += [doc.costs, [0.0]]
        start += doc.tokens
    at, cost = np.concatenate(positions), np.concatenate(costs)
    # Inside a stretch without a stop, cuts a window apart.
    wide = np.flatnonzero(np.diff(at) > window)
    inner = [np.arange(at[k] + window, at[k + 1], window) for k in wide]
    if inner:
        before = np.repeat(wide + 1, [len(cuts) for cuts in inner])
        at = np.insert(at, before, np.concatenate(inner))
        cost = np.insert(cost, before, INNER_CUT)
    return at.tolist(), cost.tolist()


def cheapest_cuts(
    positions: list[int], costs: list[float], window: int, last: bool
) -> list[int]:
    """Window ends of least cost; without ``last`` the stream goes on and its end stays open."""
    best, origin = [0.0], [0]
    queue: deque[tuple[float, int, int]] = deque()  # best + position, position, boundary
    position = positions[0]
    value = float(position)
    for j in range(1, len(positions)):
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, position, j - 1))
        position = positions[j]
        least = position - window
        while queue[0][1] < least:
            queue.popleft()
        reached, _, i = queue[0]
        value = costs[j] + reached + window
        best.append(value - position)
        origin.append(i)
    total = positions[-1]
    ends = (j for j in range(len(positions)) if positions[j] > total - window)
    j = min(ends, key=best.__getitem__)  # the rest is laid out later or by tail_cuts
    cuts = []
    while j:
        cuts.append(positions[j])
        j = origin[j]
    cuts.reverse()
    if last:
        cuts += tail_cuts(cuts[-1] if cuts else 0, total, window)
    return cuts


def tail_cuts(start: int, total: int, window: int) -> list[int]:
    """Ends of the stream's last windows: powers of two, or one padded where that is cheaper."""
    rest = total - start
    if not rest:
        return []
    if window - rest <= INNER_CUT * (rest.bit_count() - 1):
        return [total]
    ends = []
    while rest:
        size = 1 << (rest.bit_length() - 1)
        start += size
        rest -= size
        ends.append(start)
    return ends


def padded_length(length: int, window: int = WINDOW) -> int:
    return length if length.bit_count() == 1 else window


def pieces(
    docs: list[Document], cuts: list[int], first_sequence: int
) -> list[tuple[int, int, int, int, int]]:
    """Pieces up to the last cut as (document, start, length, sequence, offset)."""
    out = []
    sequence, window_start, k = first_sequence, 0, 0
    start = 0
    for n, doc in enumerate(docs):
        at = 0
        while at < doc.tokens and k < len(cuts):
            length = min(doc.tokens - at, cuts[k] - (start + at))
            out.append((n, at, length, sequence, start + at - window_start))
            at += length
            if start + at == cuts[k]:
                window_start = cuts[k]
                sequence += 1
                k += 1
        start += doc.tokens
    return out


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    columns: list[str],
    end_id: int = 2,
    window: int = WINDOW,
    with_ids: bool = True,
    remembered: int = REMEMBERED_CHUNKS,
) -> DataFrame:
    """Pieces of all ``docs``, laid into sequences of at most ``window`` tokens.

    A document is the ids of its text (null counts as empty) and ``end_id``, so every
    document has a piece. One row per piece: ``columns`` of its document, ``start``,
    ``length``, ``ids`` (with ``with_ids``), ``ids_crc32`` of the piece's ids as
    little-endian unsigned 32-bit numbers, ``doc_tokens``, ``sequence_id``, ``offset``
    and ``padded_length``. Repeated rows are separate documents; other columns are not
    read. No shuffle: each partition is packed in its order, and what does not fill its
    last window is cut into powers of two, which need no padding. An empty table gives
    no rows. ``remembered`` chunks and words, about 200 bytes each, stay in a Python worker
    between tasks; fewer save memory and cost time, the result is the same.
    """
    kept = docs.select(*columns, "text")
    keys = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "text"]
    ids_column = ["ids array<bigint>"] if with_ids else []
    schema = ", ".join(
        [*keys, "start long", "length long", *ids_column, "ids_crc32 long", "doc_tokens long",
         "sequence_id long", "offset long", "padded_length long"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_ids(tokenizer_path, remembered)
        end = np.array([end_id], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 32
        held: list[Document] = []
        done = 0  # tokens of held[0] that are already laid out
        arrow = None

        def decided(last: bool) -> pa.RecordBatch:
            nonlocal sequence, held, done
            head = held[0]
            left = head.stops > done
            rest = Document(
                head.row, head.ids[4 * done :], head.stops[left] - done, head.costs[left]
            )
            stream = [rest, *held[1:]]
            positions, costs = boundaries(stream, window)
            cuts = cheapest_cuts(positions, costs, window, last)
            rows = pieces(stream, cuts, sequence)
            sequence += len(cuts)
            values: dict[str, list] = {name: [] for name in arrow.names}
            for n, at, length, number, offset in rows:
                doc, begin = held[n], at + (done if n == 0 else 0)
                part = doc.ids[4 * begin : 4 * (begin + length)]
                for name, value in zip(columns, doc.row, strict=True):
                    values[name].append(value)
                values["start"].append(begin)
                values["length"].append(length)
                if with_ids:
                    values["ids"].append(np.frombuffer(part, "<u4").astype(np.int64))
                values["ids_crc32"].append(zlib.crc32(part))
                values["doc_tokens"].append(doc.tokens)
                values["sequence_id"].append(number)
                values["offset"].append(offset)
            sizes: dict[int, int] = {}
            for number, length in zip(values["sequence_id"], values["length"], strict=True):
                sizes[number] = sizes.get(number, 0) + length
            values["padded_length"] = [
                padded_length(sizes[number], window) for number in values["sequence_id"]
            ]
            if rows:
                n, at, length, _, _ = rows[-1]
                reached = at + length + (done if n == 0 else 0)
                if reached == held[n].tokens:
                    held, done = held[n + 1 :], 0
                else:
                    held, done = held[n:], reached
            return pa.RecordBatch.from_pydict(values, schema=arrow)

        for batch in text_slices(batches, "text"):
            if arrow is None:
                fields = [batch.schema.field(name) for name in columns]
                extra = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_length"]
                if with_ids:
                    extra.insert(2, "ids")
                fields += [
                    pa.field(name, pa.list_(pa.int64()) if name == "ids" else pa.int64())
                    for name in extra
                ]
                arrow = pa.schema(fields)
            rows = list(zip(*(batch.column(name).to_pylist() for name in columns), strict=True))
            waiting = sum(d.tokens for d in held) - done
            # The chunks are let go before the next ones are made.
            for doc in documents(
                rows, encoder.chunker.chunk_lists(texts_of(batch.column("text"))), encoder, end
            ):
                held.append(doc)
                waiting += doc.tokens
                if waiting >= SEGMENT_WINDOWS * window:
                    yield decided(last=False)
                    waiting = sum(d.tokens for d in held) - done
        if held:
            yield decided(last=True)

    return kept.mapInArrow(run, schema)
