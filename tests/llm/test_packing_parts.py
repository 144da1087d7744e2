"""Chunk ids are learnt as texts are read; places to cut are the ones a plain loop finds."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest

from bazaarlake.llm.packing import (
    INNER_CUT,
    SENTENCE_CUT,
    WORD_CUT,
    WORD_CUT_EVERY,
    ChunkIds,
    boundaries,
    document,
    documents,
)

PATH = public_tokenizers.path("word_bpe_49k.json")
END = np.array([2], "<u4").tobytes()
TEXTS = [
    "One sentence. Another, longer; one!",
    "",
    "naïve Ünder 中文。 it's don't a_b c3po 1,234.50 …",
    "x" * 3000 + ". end",
    "word, word word. " * 400,
    "<|endoftext|> and \ttext\x1fwith   separators",
]


@pytest.mark.parametrize("remembered", [1, 5, 1_000_000])
def test_chunks_encode_as_the_library_does_and_are_forgotten(remembered):
    encoder = ChunkIds(PATH, remembered)
    for text in TEXTS:
        chunks = encoder.chunker.chunks(text)
        got = np.frombuffer(b"".join(map(encoder.__getitem__, chunks)), "<u4").tolist()
        if all(isinstance(chunk, str) for chunk in chunks):
            ids = encoder.chunker.tokenizer.encode(text, add_special_tokens=False).ids
            assert got == ids
        assert len(encoder) <= remembered


def plain_boundaries(docs, encoder, window):
    positions, costs, start = [0], [0.0], 0
    for doc in docs:
        ids = np.frombuffer(doc.ids, "<u4").tolist()
        stops, goal = {}, WORD_CUT_EVERY
        for n, number in enumerate(ids[:-1], 1):
            if encoder.ends_word[number] and n >= goal:
                stops[n] = WORD_CUT
                goal = (n // WORD_CUT_EVERY + 1) * WORD_CUT_EVERY
            if encoder.ends_sentence[number]:
                stops[n] = SENTENCE_CUT
        for stop, cost in [*sorted(stops.items()), (len(ids), 0.0)]:
            while start + stop - positions[-1] > window:
                positions.append(positions[-1] + window)
                costs.append(INNER_CUT)
            positions.append(start + stop)
            costs.append(cost)
        start += len(ids)
    return positions, costs


@pytest.mark.parametrize("window", [8, 64, 4096])
def test_boundaries_equal_a_plain_loop(window):
    encoder = ChunkIds(PATH)
    docs = [document((n,), encoder.chunker.chunks(t), encoder, END) for n, t in enumerate(TEXTS)]
    assert all(isinstance(doc.stops, np.ndarray) for doc in docs)
    assert boundaries(docs, window) == plain_boundaries(docs, encoder, window)


def test_plain_words_are_encoded_without_a_split(monkeypatch):
    """A chunk that is one plain word goes to the model at once, with the library's ids."""
    encoder = ChunkIds(PATH)
    split = []
    pieces = encoder.chunker.pieces
    monkeypatch.setattr(encoder.chunker, "pieces", lambda chunk: split.append(chunk) or pieces(chunk))
    text = "tion thsterly é don't ab1 end. " + "ab" * 900 + " x"
    ids = document((1,), encoder.chunker.chunks(text), encoder, b"").ids
    library = encoder.chunker.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == library
    assert split == ["é", "don't", "ab1", "end."]


def test_a_word_is_encoded_once_whatever_signs_stand_beside_it(monkeypatch):
    encoder = ChunkIds(PATH)
    encoded = []
    tokenize = encoder._tokenize
    monkeypatch.setattr(encoder, "_tokenize", lambda word: encoded.append(word) or tokenize(word))
    text = "naïvetét. naïvetét, (naïvetét) naïvetét&&& thstly. thstly! thstly 's it's&&&"
    ids = document((1,), encoder.chunker.chunks(text), encoder, b"").ids
    library = encoder.chunker.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == library
    assert len(encoded) == len(set(encoded))


@pytest.mark.parametrize("remembered", [1, 7, 1_000_000])
def test_documents_read_together_are_those_read_alone(remembered):
    """Chunks of many texts are looked up together; ids, places and costs stay each text's own."""
    texts = [*TEXTS, " ", "  \x0b led\rby\nspace ", "<|endoftext|>" * 60, "", "ID49407 id49407 <|ENDOFTEXT|>",
             "q" * 200, "J\u030c \u0130\x85\xa0\u2028x\x1cy", "a's&&'s 12'll''t", "ä½ł 你 ä½ł. 你."]
    encoder, alone = ChunkIds(PATH, remembered), ChunkIds(PATH)
    lists = encoder.chunker.chunk_lists(texts)
    together = documents([(n,) for n in range(len(texts))], lists, encoder, END)
    assert len(encoder) <= remembered
    for n, (doc, text) in enumerate(zip(together, texts, strict=True)):
        single = document((n,), alone.chunker.chunks(text), alone, END)
        assert doc.row == (n,) and doc.ids == single.ids
        assert doc.stops.tolist() == single.stops.tolist()
        assert doc.costs.tolist() == single.costs.tolist()
        parts = alone.chunker.chunks(text)
        if all(isinstance(part, str) for part in parts):
            library = alone.chunker.tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(doc.ids, "<u4").tolist() == [*library, 2]
    assert boundaries(together, 64) == plain_boundaries(together, encoder, 64)
