"""Cut a text into the chunks a word-end BPE tokenizer encodes independently.

The tokenizer normalises (NFC, white space to one space, lower case) and then never
lets a token cross a space, so a text is a sequence of space-free chunks, and each
distinct chunk needs to be encoded once per task. Special tokens written out in a text
are matched before normalisation; they appear in the sequence as ``Special``.
"""

from __future__ import annotations

import re
from functools import cache
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer


class Special(NamedTuple):
    """A special token of the vocabulary found in a text."""

    token_id: int
    content: str

    @property
    def name(self) -> str:
        """Stands for it among chunks, which are never in upper case."""
        return f"ID{self.token_id}"


@cache
def load_tokenizer(path: str) -> Tokenizer:
    """The tokenizer, once per process; specials inside its input are ordinary text."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True
    return tokenizer


# Characters on which str.lower() and str.split() do what the normaliser does: ASCII
# without the separators 0x1c-0x1f, and the composed letters of Latin-1.
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
# The words that the pre-tokenizer finds in a chunk of them.
_PLAIN_WORDS = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class Chunker:
    """Splits texts into chunks as the tokenizer at ``path`` does."""

    def __init__(self, path: str) -> None:
        self.tokenizer = load_tokenizer(path)
        specials = {
            token.content: Special(token_id, token.content)
            for token_id, token in self.tokenizer.get_added_tokens_decoder().items()
            if token.special
        }
        self.specials = specials
        self._cut = re.compile("|".join(map(re.escape, specials))) if specials else None
        self._begins = {content[0] for content in specials}

    def chunks(self, text: str) -> list[str | Special]:
        if not self._holds_special(text):
            return self._split(text)
        out: list[str | Special] = []
        end = 0
        for found in self._cut.finditer(text):
            out += self._split(text[end : found.start()])
            out.append(self.specials[found[0]])
            end = found.end()
        return out + self._split(text[end:])

    def _holds_special(self, text: str) -> bool:
        # Few texts hold a sign that a special token begins with.
        return any(sign in text for sign in self._begins) and bool(self._cut.search(text))

    def chunk_lists(self, texts: list[str]) -> pa.ListArray:
        """The chunks of every text, specials by their names; an empty chunk has no words."""
        spaced = [
            text.lower()
            if _PLAIN.fullmatch(text) and not self._holds_special(text)
            else " ".join([chunk if isinstance(chunk, str) else chunk.name for chunk in self.chunks(text)])
            for text in texts
        ]
        return pc.ascii_split_whitespace(pa.array(spaced, pa.large_string()))

    def _split(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text):
            return text.lower().split()
        normal = self.tokenizer.normalizer.normalize_str(text)
        return [chunk for chunk in normal.split(" ") if chunk]

    def pieces(self, chunk: str) -> list[str]:
        """The chunk's words, in the byte alphabet of the vocabulary."""
        if _PLAIN.fullmatch(chunk):
            if chunk.isalpha():
                return [byte_alphabet(chunk)]
            return [byte_alphabet(word) for word in _PLAIN_WORDS.findall(chunk)]
        return [word for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(chunk)]


def _byte_letters() -> dict[int, str]:
    """Bytes that print as themselves in Latin-1 stand for themselves, the rest go on from 256."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(256 + n) for n, byte in enumerate(hidden)}


_LETTERS = _byte_letters()


def byte_alphabet(word: str) -> str:
    """The word's UTF-8 bytes, each written as one letter."""
    return word if word.isascii() else word.encode().decode("latin-1").translate(_LETTERS)
