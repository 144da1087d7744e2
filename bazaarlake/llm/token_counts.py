"""Token counts of whole texts without token ids.

A byte-level BPE tokenizer cuts a text into pre-tokens that it encodes independently, so
a text has as many tokens as its pre-tokens have pieces, each times how often it stands
there. Every document becomes its pre-token frequencies, every distinct pre-token is
counted once where its frequencies meet, and the products are summed by document.

The pre-tokens of most documents are the hot keys of that join. They are taken out of it:
each task notes which pre-tokens it met in most documents, the ``HEAD_WORDS`` foremost of
all tasks are counted and broadcast, and only the rare rest is shuffled to its counts.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from bazaarlake.llm.common import text_slices, texts_of
from bazaarlake.session import scratch_path, written

# Pre-tokens that are broadcast, and the longest of them in bytes: at most 25 MB.
HEAD_WORDS = 100_000
HEAD_BYTES = 256
# Tasks among which the documents of one longer pre-token are dealt.
SALTS = 64
# Chunks whose pre-tokens a task remembers before it forgets them all, and their length.
REMEMBERED_CHUNKS = 200_000
REMEMBERED_LENGTH = 64

RESULTS = ("n_bytes", "n_tokens", "over_limit")


# Below this code point Python's Unicode tables and the tokenizer's tell the same kinds of
# characters apart; newer letters further up they do not all know alike.
_SAME_BELOW = 0x530


def _of_kind(kind: str) -> str:
    return "".join(
        re.escape(chr(c)) for c in range(_SAME_BELOW) if unicodedata.category(chr(c))[0] == kind
    )


def _byte_level_pattern() -> re.Pattern[str]:
    """The cutting rule of byte-level tokenizers, for characters below ``_SAME_BELOW``."""
    space, letter, digit = r"\t-\r \x85\xa0", _of_kind("L"), _of_kind("N")
    return re.compile(
        rf"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+"
        rf"|[{space}]+(?![^{space}])|[{space}]+"
    )


_CUT = _byte_level_pattern()
_PLAIN = re.compile(f"[\0-{chr(_SAME_BELOW - 1)}]*")
# Python's white space takes in all that the tokenizer's does.
_CHUNK_START = re.compile(r"(?<=\S)(?= )")


class PreTokens:
    """Cuts texts into pre-tokens as the byte-level tokenizer file at ``path`` does.

    Plain texts are cut by the rule itself. In others each chunk is, and where it has
    characters beyond the plain ones, by the tokenizer. A chunk starts where a space
    follows something that is not white space: every pre-token ends there, and where the
    next ones are does not depend on what stands before. Special tokens written out in a
    text are pre-tokens of their own, which no other text is cut into.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        rule = self.tokenizer.pre_tokenizer
        plain = isinstance(rule, pre_tokenizers.ByteLevel) and rule.use_regex
        if not plain or rule.add_prefix_space or self.tokenizer.normalizer is not None:
            raise ValueError(f"{path} is not a plain byte-level tokenizer")
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(token.lstrip or token.rstrip or token.single_word for token in added):
            raise ValueError(f"{path} has added tokens that take in what is around them")
        # The longest of those that start at one place counts.
        self.specials = sorted((token.content for token in added), key=len, reverse=True)
        written = "|".join(map(re.escape, self.specials))
        self._special = re.compile(f"({written})") if written else None
        self._whole = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._known: dict[str, list[str]] = {}

    def _of_chunk(self, chunk: str) -> list[str]:
        if _PLAIN.fullmatch(chunk):
            return _CUT.findall(chunk)
        known = self._known.get(chunk)
        if known is None:
            cuts = self.tokenizer.pre_tokenizer.pre_tokenize_str(chunk)
            known = [chunk[start:end] for _, (start, end) in cuts]
            if len(chunk) <= REMEMBERED_LENGTH:
                if len(self._known) >= REMEMBERED_CHUNKS:
                    self._known.clear()
                self._known[chunk] = known
        return known

    def frequencies(self, text: str) -> Counter[str]:
        """How often each pre-token stands in ``text``."""
        parts = self._special.split(text) if self._special else [text]
        if len(parts) == 1 and _PLAIN.fullmatch(text):
            return Counter(_CUT.findall(text))
        out = Counter(parts[1::2])
        for part in parts[::2]:
            if _PLAIN.fullmatch(part):
                out.update(_CUT.findall(part))
                continue
            for chunk, times in Counter(_CHUNK_START.split(part)).items():
                for word in self._of_chunk(chunk):
                    out[word] += times
        return out

    def pieces(self, word: str) -> int:
        """Tokens of one pre-token."""
        if word in self.specials:
            return 1
        ((in_bytes, _),) = self._whole.pre_tokenize_str(word)
        return len(self.tokenizer.model.tokenize(in_bytes))


@cache
def pre_tokens(path: str) -> PreTokens:
    return PreTokens(path)


class _Foremost:
    """The pre-tokens met in most documents, as far as a bounded memory can tell."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.documents: Counter[str] = Counter()

    def see(self, words: Iterable[str]) -> None:
        self.documents.update(words)
        if len(self.documents) > 4 * self.size:
            self.documents = Counter(dict(self.documents.most_common(self.size)))

    def rows(self) -> list[tuple[str, int]]:
        top = self.documents.most_common(self.size)
        return [(w, n) for w, n in top if len(w.encode()) <= HEAD_BYTES]


def _frequencies(path: str, head_words: int):
    """(kept columns, text) to (kept columns, distinct pre-tokens, their frequencies).

    A last row of each task has the foremost pre-tokens and the documents they are in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, foremost, kind = pre_tokens(path), _Foremost(head_words), None

        def cells(kept: pa.Array, found: list[Mapping[str, int]], is_head: bool) -> pa.RecordBatch:
            ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            words = pa.array([word for counts in found for word in counts], pa.string())
            times = pa.array([n for counts in found for n in counts.values()], pa.int64())
            lists = [pa.ListArray.from_arrays(ends, words), pa.ListArray.from_arrays(ends, times)]
            flag = pa.array([is_head] * len(found))
            return pa.RecordBatch.from_arrays([kept, *lists, flag], ["kept", "words", "times", "is_head"])

        for batch in text_slices(batches, "text", 2_000_000):
            kind = batch.column("kept").type
            found = [cutter.frequencies(text) for text in texts_of(batch.column("text"))]
            for counts in found:
                foremost.see(counts)
            yield cells(batch.column("kept"), found, False)
        if kind is not None:
            yield cells(pa.nulls(1, kind), [dict(foremost.rows())], True)

    return run


def _pieces(path: str):
    """Adds ``pieces`` to each ``word``; neighbours that are equal are counted once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, before, pieces = pre_tokens(path), None, 0
        for batch in batches:
            counts = []
            for word in batch.column("word").to_pylist():
                if word != before:
                    before, pieces = word, cutter.pieces(word)
                counts.append(pieces)
            names = [*batch.schema.names, "pieces"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], names)

    return run


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    columns: list[str],
    limit: int = 512,
    head_words: int = HEAD_WORDS,
) -> DataFrame:
    """``n_bytes``, ``n_tokens`` and ``over_limit`` of every ``docs.text``, beside ``columns``.

    ``n_tokens`` is what the byte-level tokenizer file gives without begin, end or other
    tokens added; special strings inside a text are one token. ``n_bytes`` is the text's
    length in UTF-8, ``over_limit`` says it has more than ``limit`` tokens. A null text
    counts as empty: no bytes, no tokens. Every row is counted, also repeated ones and
    those without an id; an empty table gives no rows. Other columns are not read;
    ``columns`` named like a result are refused.

    ``head_words`` sets how many pre-tokens are broadcast, never which are counted. What a
    task notes of them is cut to a bounded size; that decides the way a pre-token takes
    and not what it counts.
    """
    clash = {name.lower() for name in columns} & set(RESULTS)
    if clash:
        raise ValueError(f"columns named like results: {sorted(clash)}")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.struct(F.struct(*columns).alias("row"), F.octet_length(text).alias("bytes"))
    kept = docs.select(row.alias("kept"), text.alias("text"))
    kind = kept.schema["kept"].dataType.simpleString()
    # Written once: numbers the rows for good and keeps the texts from being cut again.
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "pre-tokens")
    kept.mapInArrow(
        _frequencies(tokenizer_path, head_words),
        f"kept {kind}, words array<string>, times array<long>, is_head boolean",
    ).withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    counted = spark.read.parquet(path)

    def cells(is_head: bool) -> DataFrame:
        zipped = F.arrays_zip(F.col("words").alias("word"), F.col("times").alias("times"))
        return counted.where(F.col("is_head") == is_head).select("row", F.inline(zipped))

    head = written(
        cells(True)
        .groupBy("word")
        .agg(F.sum("times").alias("documents"))
        .orderBy(F.desc("documents"), "word")
        .limit(head_words)
        .select("word")
        .mapInArrow(_pieces(tokenizer_path), "word string, pieces long"),
        "head-pieces",
    )
    tokens = F.sum(F.col("times") * F.col("pieces")).alias("tokens")
    common = cells(False).join(F.broadcast(head), "word").groupBy("row").agg(tokens)
    # Rare pre-tokens need no salt; the long ones kept out of the head may not be rare.
    salt = F.when(F.octet_length("word") > HEAD_BYTES, F.pmod(F.xxhash64("row"), F.lit(SALTS)))
    rare = (
        cells(False)
        .join(F.broadcast(head), "word", "left_anti")
        .repartition("word", salt)
        .sortWithinPartitions("word")
        .select("row", "word", "times")
        .mapInArrow(_pieces(tokenizer_path), "row long, word string, times long, pieces long")
        .groupBy("row")
        .agg(tokens)
    )
    sums = common.unionAll(rare).groupBy("row").agg(F.sum("tokens").alias("tokens"))
    total = F.coalesce("tokens", F.lit(0))
    return (
        counted.where(~F.col("is_head"))
        .select("row", "kept")
        .join(sums, "row", "left")
        .select(
            "kept.row.*",
            F.col("kept.bytes").cast("long").alias("n_bytes"),
            total.alias("n_tokens"),
            (total > limit).alias("over_limit"),
        )
    )
