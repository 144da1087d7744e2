"""BPE encoding and decoding by depth-first traversal of a trie of distinct words.

What a word's prefix encodes to does not depend on what follows it, except that the
last character of a word carries the word-end mark. So every node of the trie needs one
state: the last token of its prefix. The encoding of the prefix is that token behind
the encoding of the node that many characters further up. A node's last token is the
one token that ends there and may stand behind the last token of the node at its start.
Two tokens may stand side by side if BPE, run over both together, leaves them apart.

Visiting the distinct words in sorted order visits the trie depth first: the part of
the path shared with the word before is kept, the rest is worked out anew.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import cache
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame

from bazaarlake.llm.common import text_slices, texts_of
from bazaarlake.llm.words import Chunker, Special

# Distinct chunks remembered by one task before it forgets them all: bounds memory only.
REMEMBERED_CHUNKS = 600_000


class TrieEncoder:
    """Encodes words over the vocabulary file at ``path``."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.tokens = {number: token for token, number in self.ids.items()}
        self.names = {number: str(number) for number in self.tokens}
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        # Tokens reachable by merges, by their text without and with the end mark.
        reachable = {a + b for a, b in self.ranks} | {t for t in self.ids if self._single(t)}
        self.inner = {t: self.ids[t] for t in reachable if not self._ends(t)}
        self.final = {
            t.removesuffix(self.end): self.ids[t] for t in reachable if self._ends(t)
        }
        # Suffix automaton over the tokens, built as it is met: what a node's prefix ends
        # with that some token starts with, and the tokens that end there, longest first.
        texts = self.inner.keys() | self.final.keys()
        self._starts = {text[:n] for text in texts for n in range(len(text) + 1)}
        self._next: dict[str, str] = {}
        self._ending: dict[str, list[tuple[int, int]]] = {}
        self._ending_word: dict[str, list[tuple[int, int]]] = {}
        self._beside: dict[int, bool] = {}

    def _ends(self, token: str) -> bool:
        return bool(self.end) and token.endswith(self.end) and token != self.end

    def _single(self, token: str) -> bool:
        return len(token.removesuffix(self.end) if self._ends(token) else token) == 1

    def _symbols(self, token_id: int) -> list[str]:
        token = self.tokens[token_id]
        if self._ends(token):
            text = token.removesuffix(self.end)
            return [*text[:-1], text[-1] + self.end]
        return list(token)

    def _may_stand(self, left: int, right: int) -> bool:
        """Whether BPE over the two tokens' characters ends with just these two."""
        parts = self._symbols(left) + self._symbols(right)
        never = len(self.ranks)
        while len(parts) > 2:
            rank, at = min(
                (self.ranks.get((parts[i], parts[i + 1]), never), i)
                for i in range(len(parts) - 1)
            )
            if rank == never:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        apart = parts == [self.tokens[left], self.tokens[right]]
        return apart and (parts[0], parts[1]) not in self.ranks

    def _follow(self, met: str) -> str:
        """The longest end of ``met`` that some token starts with."""
        end = met
        while end not in self._starts:
            end = end[1:]
        self._next[met] = end
        if end not in self._ending:
            for vocabulary, ending in (
                (self.inner, self._ending),
                (self.final if self.end else self.inner, self._ending_word),
            ):
                tails = [end[i:] for i in range(len(end))]
                ending[end] = [(vocabulary[t], len(t)) for t in tails if t in vocabulary]
        return end

    def _last(self, candidates: list[tuple[int, int]], path: list[int], to: int) -> tuple[int, int]:
        """The token that ends at depth ``to`` and may stand behind what is before it."""
        beside = self._beside
        for token, size in candidates:
            before = path[to - size]
            if before < 0:
                return token, size
            pair = before << 32 | token
            apart = beside.get(pair)
            if apart is None:
                apart = beside[pair] = self._may_stand(before, token)
            if apart:
                return token, size
        raise ValueError(f"no token of the vocabulary ends at depth {to}")

    def encode(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Each distinct word (in the vocabulary's byte alphabet) with its token ids."""
        # By depth: last token, its length, what the automaton has met.
        path, sizes, met = [-1], [0], [""]
        before = ""
        follow, last = self._next, self._last
        for word in sorted(set(words)):
            if not word:
                continue
            depth = min(len(commonprefix((before, word))), len(word) - 1, len(path) - 1) + 1
            del path[depth:], sizes[depth:], met[depth:]
            state = met[-1]
            for depth in range(depth, len(word)):
                state += word[depth - 1]
                state = follow.get(state) or self._follow(state)
                token, size = last(self._ending[state], path, depth)
                path.append(token)
                sizes.append(size)
                met.append(state)
            at = len(word)
            state += word[-1]
            state = follow.get(state) or self._follow(state)
            token, size = last(self._ending_word[state], path, at)
            ids = [token]
            at -= size
            while at:
                ids.append(path[at])
                at -= sizes[at]
            ids.reverse()
            yield word, ids
            before = word


@cache
def trie_encoder(path: str) -> TrieEncoder:
    return TrieEncoder(path)


class TextCodec:
    """Encodes and decodes whole texts, each distinct chunk once until it is forgotten."""

    def __init__(self, path: str, remembered: int = REMEMBERED_CHUNKS) -> None:
        self.chunker = Chunker(path)
        self.trie = trie_encoder(path)
        self.remembered = remembered
        self._known: dict = {}

    def learn(self, chunk_lists: list[list]) -> dict:
        """(number of tokens, ids joined by a space, decoded text) of every chunk given."""
        fresh = set().union(*chunk_lists) - self._known.keys()
        if len(self._known) + len(fresh) > self.remembered:
            self._known = {}
            fresh = set().union(*chunk_lists)
        known, pieces = self._known, {}
        for chunk in fresh:
            if isinstance(chunk, Special):
                known[chunk] = (1, str(chunk.token_id), chunk.content)
            else:
                pieces[chunk] = self.chunker.pieces(chunk)
        names, tokens, words = self.trie.names, self.trie.tokens, {}
        for word, ids in self.trie.encode([w for parts in pieces.values() for w in parts]):
            if len(ids) == 1:
                words[word] = (1, names[ids[0]], tokens[ids[0]])
            else:
                words[word] = (
                    len(ids),
                    " ".join([names[i] for i in ids]),
                    " ".join([tokens[i] for i in ids]),
                )
        for chunk, parts in pieces.items():
            n, ids, text = words[parts[0]]
            for part in parts[1:]:
                more_n, more_ids, more_text = words[part]
                n, ids, text = n + more_n, f"{ids} {more_ids}", f"{text} {more_text}"
            known[chunk] = (n, ids, text)
        return self._known


ENCODED = "n_tokens long, ids string, decoded string"


def encode_and_decode(
    docs: DataFrame, tokenizer_path: str, columns: list[str], digest: bool = False
) -> DataFrame:
    """Token ids of ``docs.text`` and the text decoded from them, beside ``columns``.

    ``ids`` are decimal, joined by one space; ``decoded`` is what the tokenizer's decode
    gives for them, specials kept. With ``digest`` both are replaced by their SHA-256
    (``ids_sha256``, ``decoded_sha256``). A null text counts as empty: no tokens and an
    empty decoded text. Repeated rows are encoded each, other columns are not read.
    Work stays within a task: no shuffle, memory bounded by the chunks remembered.
    """
    kept = docs.select(*columns, "text")
    names = ("n_tokens", "ids_sha256", "decoded_sha256") if digest else ("n_tokens", "ids", "decoded")
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "text"]
        + [f"{names[0]} long, {names[1]} string, {names[2]} string"]
    )

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TextCodec(tokenizer_path)
        for batch in text_slices(batches, "text", 8_000_000):
            lists = [codec.chunker.chunks(text) for text in texts_of(batch.column("text"))]
            known = codec.learn(lists)
            counts, ids, decoded = [], [], []
            for chunks in lists:
                found = [known[chunk] for chunk in chunks]
                counts.append(sum([x[0] for x in found]))
                joined = " ".join([x[1] for x in found])
                text = " ".join([x[2] for x in found])
                ids.append(sha(joined) if digest else joined)
                decoded.append(sha(text) if digest else text)
            arrays = [batch.column(name) for name in columns]
            arrays += [pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, *names])

    return kept.mapInArrow(run, schema)
