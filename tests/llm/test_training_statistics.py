"""Whitening, conversation repair and token counts against brute force and the library."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bazaarlake.llm import whitening
from bazaarlake.llm.queries import (
    damaged,
    op11_whitening,
    op12_turn_repair,
    op13_token_counts,
)
from bazaarlake.llm.token_counts import PreTokens, count_tokens
from bazaarlake.llm.turn_repair import repair
from bazaarlake.llm.whitening import Spectrum, rank_one_update, whiten

# -- whitening -------------------------------------------------------------------------


@pytest.mark.parametrize("size", [1, 2, 7, 40])
def test_rank_one_updates_against_a_dense_solver(size):
    rng = np.random.default_rng(size)
    values, vectors = np.zeros(size), np.eye(size)
    dense = np.zeros((size, size))
    steps = [rng.normal(size=size) * 10.0 ** rng.integers(-6, 6) for _ in range(3 * size)]
    steps += [steps[0], np.zeros(size), np.eye(size)[0], np.ones(size)]
    for x in steps:
        values, vectors = rank_one_update(values, vectors, x)
        dense += np.outer(x, x)
        scale = np.abs(dense).max() or 1.0
        assert np.abs(vectors * values @ vectors.T - dense).max() <= 1e-12 * scale
        assert np.abs(vectors.T @ vectors - np.eye(size)).max() <= 1e-12
        # Rounding may leave equal values in either order.
        assert (np.diff(np.sort(values)) >= 0).all() and (values >= -1e-12 * scale).all()


def test_spectra_combine_in_any_split():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(200, 6)) @ np.diag([9, 3, 3, 1, 0, 0.1]) * 50) + 1000
    whole = np.cov(x.T, bias=True) * len(x)
    for cuts in ([1, 2, 3], [50, 51, 199], [100]):
        total = Spectrum.empty(6)
        for part in np.split(x, cuts):
            own = Spectrum.empty(6)
            for row in range(0, len(part), 13):
                own.add_rows(part[row : row + 13])
            total.combine(own)
        assert total.n == 200 and np.allclose(total.mean, x.mean(axis=0), rtol=1e-13)
        found = total.vectors * total.values @ total.vectors.T
        assert np.abs(found - whole).max() <= 1e-11 * np.abs(whole).max()


def expected_whitening(vectors, k):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], dtype=object)
    fit = sorted({tuple(row) for row in x})
    n, sums = len(fit), [sum(column) for column in zip(*fit, strict=True)]
    centred = np.array([[float(v * n - s) / n for v, s in zip(row, sums, strict=True)] for row in fit])
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    lead = np.argsort(-values)[:k]
    rows = np.array([[float(v * n - s) / n for v, s in zip(row, sums, strict=True)] for row in x])
    deviations = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return n, deviations, rows @ basis[:, lead] / np.sqrt(values[lead]), values[lead] / values.sum()


def check_whitening(found, ids, vectors, k):
    n, deviations, whitened, explained = expected_whitening(vectors, k)
    rows = {(r[0], r.component): r for r in found}
    assert len(rows) == len(found) == len(ids) * k
    assert {r.n for r in found} == {n}
    assert all(0 <= r.identity_error <= 1e-10 for r in found)
    for c in range(k):
        own = [rows[i, c + 1] for i in ids]
        assert [r.deviation for r in own] == deviations
        column = np.array([r.whitened for r in own])
        sign = np.sign(column @ whitened[:, c])
        assert np.abs(column - sign * whitened[:, c]).max() <= 1e-9
        assert all(abs(r.explained / explained[c] - 1) <= 1e-9 for r in own)


def test_whitening_of_the_test_table(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()
    found = op11_whitening(spark, sf_small).collect()
    check_whitening(found, [r.vec_id for r in rows], [r.embedding for r in rows], 16)


def test_whitening_over_many_partitions(spark, conf, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    conf(adaptive__coalescePartitions__enabled="false")
    rng = np.random.default_rng(8)
    vectors = (rng.normal(size=(150, 5)) @ rng.normal(size=(5, 5)) * 3).tolist()
    vectors += [vectors[0]] * 70  # a third of the rows are one vector
    rows = [(i, v, "x", 0) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "key long, v array<double>, n string, component int").repartition(7)
    check_whitening(whiten(df, "key", "v").collect(), range(len(rows)), vectors, 5)
    with pytest.raises(ValueError):
        whiten(df, "n", "v")


def test_whitening_leaves_out_and_keeps(spark):
    schema = "vec_id long, v array<double>"
    whole = [[1.0, 2.0], [2.0, 0.5], [1.0, 2.0], [-3.0, 1.0]]
    odd = [None, [], [1.0, None], [math.nan, 1.0], [math.inf, 0.0], [5.0], [7.0, 8.0, 9.0]]
    rows = [(i, v) for i, v in enumerate(whole)] + [(None, v) for v in odd]
    found = whiten(spark.createDataFrame(rows, schema), "vec_id", "v").collect()
    # A length with one distinct vector has no variance, so no components.
    check_whitening(found, range(4), whole, 2)
    assert whiten(spark.createDataFrame([], schema), "vec_id", "v").count() == 0
    assert whiten(spark.createDataFrame([(1, None)], schema), "vec_id", "v").count() == 0
    same = spark.createDataFrame([(1, [2.0, 3.0]), (2, [2.0, 3.0])], schema)
    assert whiten(same, "vec_id", "v").count() == 0


def test_whitening_of_large_entries(spark):
    vectors = [[1e15, 1.0], [-1e15, 2.0], [3e14, 1.0], [1.0, 5.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "i long, v array<double>")
    found = whiten(df, "i", "v").collect()
    assert {r.deviation for r in found} == {None}  # beyond a long
    assert all(math.isfinite(r.whitened) for r in found)
    held = spark.createDataFrame([(1, [1e300]), (2, [-1e300]), (3, [0.0])], "i long, v array<double>")
    assert sorted(round(r.whitened, 4) for r in whiten(held, "i", "v").collect()) == [-1.2247, 0.0, 1.2247]


# -- conversation repair ---------------------------------------------------------------

REPAIRED = re.compile("(s?(ua)+)?")
ON_THE_WAY = re.compile("(s?(ua)*u?)?")
ROLE = {"u": "user", "a": "assistant"}


def faults_of(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        if not shown:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("sound" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return faults


def every_repair(rows, faults, limit):
    """(cost, letters, repaired rows) of all edits up to ``limit``, in no clever order."""
    found = []

    def go_on(i, cost, letters, out, initials):
        if cost > limit:
            return
        for added in ("", "u", "a", "ua", "au"):
            shape, price = initials + added, cost + 2 * len(added)
            lines = out + [(ROLE[x], "") for x in added]
            marks = letters + "I" * len(added)
            if not ON_THE_WAY.fullmatch(shape) or price > limit:
                continue
            if i == len(rows):
                if REPAIRED.fullmatch(shape):
                    found.append((price, marks, lines))
                continue
            _, role, text = rows[i]
            go_on(i + 1, price + 3, marks + "D", lines, shape)
            if faults[i] in ("sound", "truncated"):
                cut = faults[i] == "truncated"
                if role and ON_THE_WAY.fullmatch(shape + role[0]):
                    go_on(i + 1, price + cut, marks + "K", [*lines, (role, text)], shape + role[0])
                for x in "ua":
                    if ON_THE_WAY.fullmatch(shape + x):
                        go_on(i + 1, price + cut + 2, marks + "R", [*lines, (ROLE[x], text)], shape + x)

    go_on(0, 0, "", [], "")
    return found


def expected_report(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults = faults_of(rows)
    cost, letters, lines = min(every_repair(rows, faults, 3 * len(rows)), key=lambda r: r[:2])
    turns = [turn for turn, _, _ in rows if turn is not None]
    initials = [role[:1] for _, role, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
        cost, letters,
        hashlib.sha256("\n".join(f"{role}:{text}" for role, text in lines).encode()).hexdigest(),
    )


TURNS = "conv_id long, turn long, role string, text string, edit int"


def test_repairs_against_every_repair(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", " ", ""]
    texts = ["hi.", "yo", "", " \n", "ok!\n", "a b.", "q?", "é\x0b"]
    made = {
        c: [(rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(texts)) for _ in range(rng.randrange(6))]
        for c in range(250)
    }
    rows = [(c, *row, 1) for c, own in made.items() for row in own]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, TURNS)
    named = spark.createDataFrame([(c,) for c in made], "conv_id long")
    found = repair(df, conversations=named, edits=False, block_turns=2).collect()
    assert len(found) == len(made)
    for r in found:
        assert tuple(r)[1:] == expected_report(made[r.conv_id]), made[r.conv_id]

    # The edits themselves, in blocks of another size, give the same.
    reports = {r.conv_id: r for r in found}
    edits = {}
    for r in repair(df, block_turns=3).orderBy("conv_id", "edit_no").collect():
        edits.setdefault(r.conv_id, []).append(r)
    assert set(edits) == {c for c, own in made.items() if own}
    for conv, own in edits.items():
        assert [r.edit_no for r in own] == list(range(len(own)))
        assert "".join(r.edit for r in own) == reports[conv].audit
        lines = "\n".join(f"{r.role}:{r.text}" for r in own if r.edit != "D")
        assert hashlib.sha256(lines.encode()).hexdigest() == reports[conv].repaired_sha256
        assert all((r.turn, r.text) == (None, "") for r in own if r.edit == "I")


def test_one_giant_conversation(spark, conf):
    conf(execution__arrow__maxRecordsPerBatch="50")
    # The same text over and over in one role: all but the first of each are repeats.
    many = spark.range(3000).select(
        F.lit(7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.when(F.col("id") % 3 == 0, "same.").otherwise(F.concat(F.col("id"), F.lit("."))).alias("text"),
    )
    few = spark.createDataFrame([(None, None, None, None), (1, 0, "user", "x" * 200_000)],
                                "conv_id long, turn long, role string, text string")
    rows = {r.conv_id: r for r in repair(many.union(few), edits=False, block_turns=64).collect()}
    giant = rows[7]
    assert (giant.duplicate, giant.blank, giant.gaps, giant.illegal) == (998, 0, 0, 0)
    assert len(giant.audit.replace("I", "")) == 3000
    assert giant.cost == sum({"D": 3, "I": 2, "R": 2, "K": 0}[x] for x in giant.audit)
    assert giant.audit.count("D") >= 998
    assert (rows[None].audit, rows[None].blank, rows[None].cost) == ("D", 1, 3)
    assert (rows[1].audit, rows[1].truncated) == ("D", 1)


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], TURNS)
    assert repair(none).count() == 0 and repair(none, edits=False).count() == 0
    left = repair(none, conversations=spark.createDataFrame([(3,), (None,)], "conv_id long"), edits=False)
    empty = hashlib.sha256(b"").hexdigest()
    assert {tuple(r) for r in left.collect()} == {(c, 0, 0, 0, 0, 0, 0, "", empty) for c in (3, None)}
    with pytest.raises(ValueError):
        repair(none.withColumnRenamed("conv_id", "cost"), "cost")


def test_damage_and_reports_of_the_test_table(spark, sf_small):
    import zlib

    made, given = {}, spark.read.parquet(f"{sf_small}/conversations.parquet").collect()
    for r in given:
        own = made.setdefault(r.conv_id, [])
        role, text = r.role or " ", r.text if r.text is not None else " "
        fault = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            own += [(r.turn, "user" if fault == 4 else role, text)] * (1 + (fault == 3))
    rows = damaged(spark.read.parquet(f"{sf_small}/conversations.parquet")).collect()
    assert sorted(map(tuple, rows)) == sorted((c, *row) for c, own in made.items() for row in own)
    found = {r.conv_id: tuple(r)[1:] for r in op12_turn_repair(spark, sf_small).collect()}
    assert set(found) == set(made)
    for conv in sorted(made)[:40]:
        assert found[conv] == expected_report(made[conv])


# -- token counts ----------------------------------------------------------------------

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def library_count(text):
    return len(Tokenizer.from_file(BYTE_BPE).encode(text, add_special_tokens=False).ids)


def test_pre_tokens_add_up_to_the_library():
    library, cutter, rng = Tokenizer.from_file(BYTE_BPE), PreTokens(BYTE_BPE), random.Random(9)
    letters = [*" \n\t'sre a1!é中　\x1c🙂\U00010940\xa0", "<|endoftext|>", "<|endof", " ", " ", "don't"]
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(25)))
        found = sum(n * cutter.pieces(word) for word, n in cutter.frequencies(text).items())
        assert found == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_counts_of_the_test_table(spark, sf_small):
    library = Tokenizer.from_file(BYTE_BPE)
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    found = op13_token_counts(spark, sf_small).collect()
    assert len(found) == len(docs)
    for r in found:
        n = len(library.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 512)


@pytest.mark.parametrize("head_words", [0, 2, 1000])
def test_counts_of_odd_texts(spark, head_words):
    texts = [None, "", " ", "\n\n", "the the the", "<|endoftext|><|endoftext|>", "x" * 300_000,
             "no space " * 3, "no space " * 3, "é中🙂", "a  b\n c"]
    rows = [(i % 3 or None, text, 5, "w") for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int, word string").repartition(3)
    found = count_tokens(df, BYTE_BPE, ["doc_id", "row", "word"], head_words=head_words)
    assert found.columns == ["doc_id", "row", "word", "n_bytes", "n_tokens", "over_limit"]
    expected = [(i, 5, "w", len((t or "").encode()), library_count(t or ""), library_count(t or "") > 512)
                for i, t, _, _ in rows]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))


def test_counts_refuse_and_take_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string, n_tokens int")
    assert count_tokens(none, BYTE_BPE, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        count_tokens(none, BYTE_BPE, ["n_tokens"])
    with pytest.raises(ValueError):
        PreTokens(public_tokenizers.path("word_bpe_49k.json"))
