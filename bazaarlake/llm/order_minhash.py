"""Near-duplicate texts by order MinHash, verified by banded alignment.

A text is its words, lower-cased; its k-mers are runs of five words, each labelled with
how often it occurred before. A sketch takes the two least labelled k-mers under a hash
and keeps them in text order, so two texts agree in it only if they share both, in the
same order: alike under edits, not just in content. Texts that agree in a sketch are
candidates; they are near duplicates if the words changed, by a banded alignment, are at
most a fifth of the longer text. Groups are the connected components.

Two texts that share fewer than two k-mers never meet: under about 25 words a pair may be
near duplicates by its edits and still be missed.

A sketch's bucket isn't paired up: its texts are compared with the least one. Where its
texts are then still in several groups, whether they are like the least one says nothing
about the others. The texts of such a bucket meet in blocks, each two of them in the first
bucket they have in common, where those of like lengths and different groups are compared.
A bucket of thousands isn't paired up: its texts meet by their rarest words. Near duplicates
of n words differ in at most a fifth of them, so they share one of the rarest fifth and one
more, under any order of words that is the same for all texts. Thousands of texts that have
only a passage in common don't meet so, as its words are not rare. So any two near
duplicates of a bucket are compared or in one group already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.alignment import may_be_similar, similar
from bazaarlake.llm.common import text_slices
from bazaarlake.llm.components import components, merged
from bazaarlake.session import written

SIMILARITY = 0.8
K = 5
SKETCHES = 48
ROUNDS = 2
# Texts of one bucket or rare word that meet in one task: two parts of about so many.
PART = 512
# Parts of a bucket whose texts meet by the bucket itself, each row so many times at most.
WHOLE_PARTS = 8
# Counters that tell rare words from frequent ones, some words to each. They decide in
# which order words are tried and so the time it takes, not what is found.
COUNTERS = 1 << 18
# Pairs of a group that are compared at once; more go one text after the other.
AT_ONCE = 64
# Keys of a group whose texts are told in one matrix.
KEYS_AT_ONCE = 256

_MAX = np.iinfo(np.uint64).max


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; equal ones stay equal, different ones different."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _odd(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1)


_PLACES = _odd(K, 1)
_ORDERS = _odd(SKETCHES, 2)
_FIRST, _SECOND, _AGAIN = _odd(3, 3)
_CLASS = _odd(1, 4)[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and where each text's words begin and end."""
    plain = pc.utf8_trim_whitespace(pc.utf8_lower(texts.fill_null("")))
    split = pc.utf8_split_whitespace(plain)
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    # The empty text splits into one empty word.
    empty = pc.equal(plain, "").to_numpy(zero_copy_only=False)
    words = split.flatten()
    words = words.filter(pc.not_equal(words, ""))
    counts[empty] = 0
    coded = words.dictionary_encode()
    known = np.array([xxhash.xxh3_64_intdigest(w.encode()) for w in coded.dictionary.to_pylist()], np.uint64)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    return known[codes] if len(codes) else np.zeros(0, np.uint64), np.concatenate([[0], counts.cumsum()])


def kmers(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-mers of all texts, and their bounds; a shorter text is one k-mer."""
    counts = np.diff(bounds)
    # Texts laid out with at least K words each; missing words are 0.
    room = np.where(counts > 0, np.maximum(counts, K), 0)
    starts = np.concatenate([[0], room.cumsum()])
    laid = np.zeros(int(starts[-1]) + K, np.uint64)
    owner = np.repeat(np.arange(len(counts)), counts)
    laid[np.arange(len(words)) - bounds[owner] + starts[owner]] = words
    runs = np.zeros(len(laid) - K, np.uint64)
    for place in range(K):
        runs += _mix(laid[place : place + len(runs)]) * _PLACES[place]
    kept = np.maximum(room - K + 1, 0)
    begins = np.concatenate([[0], kept.cumsum()])
    of = np.repeat(np.arange(len(counts)), kept)
    return _mix(runs[np.arange(len(of)) - begins[of] + starts[of]]), begins


def numbered(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Hashes of ``values``, each with how often it occurred before in its text ``of``."""
    key = values + _mix(of.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[order][1:] != key[order][:-1]
    at = np.arange(len(key))
    occurrence = np.empty(len(key), np.uint64)
    occurrence[order] = (at - np.maximum.accumulate(np.where(fresh, at, 0))).astype(np.uint64)
    return _mix(values + occurrence * _AGAIN)


def sketches(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sketches of each text with words, one row per text; texts without any have zeros."""
    runs, begins = kmers(words, bounds)
    counts = np.diff(begins)
    out = np.zeros((len(counts), SKETCHES), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    starts, sizes = begins[some], counts[some]
    of = np.repeat(np.arange(len(some)), sizes)
    labelled = numbered(runs, of)

    def least(values: np.ndarray) -> np.ndarray:
        """Position of each text's least value, the first of equal ones."""
        hits = np.flatnonzero(values == np.repeat(np.minimum.reduceat(values, starts), sizes))
        if len(hits) > len(starts):
            hits = hits[np.unique(of[hits], return_index=True)[1]]
        return hits

    for number, factor in enumerate(_ORDERS):
        values = labelled * factor
        one = least(values)
        values[one] = _MAX
        other = least(values)
        before, behind = np.minimum(one, other), np.maximum(one, other)
        out[some, number] = _mix(
            runs[before] * _FIRST + runs[behind] * _SECOND + np.uint64(number)
        )
    return out


def _contents(words: np.ndarray, bounds: np.ndarray) -> list[str | None]:
    """Equal for texts of equal words; null for a text without words."""
    return [
        xxhash.xxh3_128_hexdigest(words[a:b].tobytes()) if b > a else None
        for a, b in zip(bounds[:-1], bounds[1:], strict=True)
    ]


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        words, bounds = word_hashes(batch.column("text"))
        values = sketches(words, bounds).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(_contents(words, bounds), pa.string()), pa.array(list(values))],
            ["doc_id", "content", "sketches"],
        )


def _with_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        words, bounds = word_hashes(batch.column("text"))
        cells = [words[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(cells, pa.binary())], ["node", "words"])


def _verified(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "a_words"):
            sides = (batch.column(name).to_pylist() for name in ("a_words", "b_words"))
            pairs = [
                (np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64))
                for a, b in zip(*sides, strict=True)
            ]
            alike = similar(pairs, similarity)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(alike, pa.bool_())], ["a", "b", "alike"]
            )

    return run


def _texts(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The word hashes of each row, all its labelled words, and which row each is of."""
    words = [np.frombuffer(cell, np.uint64) for cell in batch.column("words").to_pylist()]
    of = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return words, numbered(np.concatenate([np.zeros(0, np.uint64), *words]), of), of


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros(COUNTERS, np.int64)
    for batch in text_slices(batches, "words"):
        _, labelled, _ = _texts(batch)
        totals += np.bincount((labelled % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
    some = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], ["counter", "words"])


def rare_keys(
    labelled: np.ndarray, of: np.ndarray, sizes: np.ndarray, counts: np.ndarray, similarity: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys by which similar texts meet, whose text each is, and if it is of the text's own length class.

    A key is one of the rarest words and a class of lengths. Similar texts are in one class
    or in adjacent ones, so each text has the keys of its own and of the next longer class.
    """
    order = np.lexsort((labelled, counts[(labelled % np.uint64(COUNTERS)).astype(np.int64)], of))
    starts = np.cumsum(sizes) - sizes
    rank = np.arange(len(of)) - starts[of]
    kept = rank <= np.floor((1 - similarity) * sizes + 1e-9)[of]
    words, owner = labelled[order][kept], of[kept]
    # A little wider than the similarity, so that rounding never puts a class between two texts.
    classes = (np.log(np.maximum(sizes, 1)) / -np.log(similarity - 1e-6)).astype(np.uint64)[owner]
    keys = [_mix(words + (classes + np.uint64(step)) * _CLASS) for step in (0, 1)]
    own = np.repeat([True, False], len(words))
    return np.concatenate(keys), np.concatenate([owner, owner]), own


def _rarest(similarity: float, counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "words"):
            words, labelled, of = _texts(batch)
            sizes = np.array([len(w) for w in words])
            keys, owner, own = rare_keys(labelled, of, sizes, counts, similarity)
            owner = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node").take(owner), batch.column("component").take(owner),
                    pa.array(keys.view(np.int64)), pa.array(own),
                ],
                ["node", "component", "key", "own"],
            )

    return run


def _met_before(keys: list[np.ndarray], owned: list[np.ndarray], key: int) -> np.ndarray:
    """For every two texts, whether a lesser key than ``key`` compares them.

    A key compares two texts that both have it, one of them as of its own length class.
    """
    lesser = [row < key for row in keys]
    of = np.repeat(np.arange(len(keys)), [int(some.sum()) for some in lesser])
    values = np.concatenate([k[some] for k, some in zip(keys, lesser, strict=True)])
    other = ~np.concatenate([o[some] for o, some in zip(owned, lesser, strict=True)])
    column, times = np.unique(values, return_inverse=True, return_counts=True)[1:]
    # Keys that a single text has compare nothing here.
    number = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[column]
    before = np.zeros((len(keys), len(keys)), np.float32)
    for start in range(0, int((times > 1).sum()), KEYS_AT_ONCE):
        some = (number >= start) & (number < start + KEYS_AT_ONCE)
        has, foreign = np.zeros((2, len(keys), KEYS_AT_ONCE), np.float32)
        has[of[some], number[some] - start] = 1
        foreign[of[some & other], number[some & other] - start] = 1
        before += has @ has.T - foreign @ foreign.T
    return before > 0


def _links_met(similarity: float):
    """Links between the components of texts that meet, from rows in the order of their meetings."""

    def links(batch: pa.RecordBatch, begins: np.ndarray) -> Iterator[tuple[int, int]]:
        words = [np.frombuffer(cell, np.uint64) for cell in batch.column("words").to_pylist()]
        sizes = np.array([len(w) for w in words])
        keys, owned = (
            [cell.values.to_numpy(zero_copy_only=False) for cell in batch.column(name)]
            for name in ("keys", "owned")
        )
        key, component, part, low, high = (
            batch.column(name).to_numpy() for name in ("key", "component", "part", "low", "high")
        )
        own = batch.column("own").to_numpy(zero_copy_only=False)
        waiting: list[tuple[int, int]] = []
        for begin, end in zip(begins, [*begins[1:], len(words)], strict=True):
            label = component[begin:end].copy()
            possible = np.tril(label[:, None] != label[None, :])
            if low[begin] != high[begin]:
                possible &= part[begin:end, None] != part[None, begin:end]
            possible &= own[begin:end, None] | own[None, begin:end]
            length = sizes[begin:end]
            least = similarity * np.maximum(length[:, None], length[None, :]) - 1e-6
            possible &= np.minimum(length[:, None], length[None, :]) >= least
            if possible.sum() > AT_ONCE:
                possible &= may_be_similar(words[begin:end], similarity)
            some = np.flatnonzero(possible.any(axis=0) | possible.any(axis=1))
            if not len(some):
                continue
            possible = possible[np.ix_(some, some)]
            label, at = label[some], begin + some
            possible &= ~_met_before([keys[n] for n in at], [owned[n] for n in at], key[begin])
            met = np.argwhere(possible)
            if len(met) <= AT_ONCE:
                waiting += [(at[i], at[j]) for i, j in met]
                continue
            # One text after the other, so that texts already linked need no comparison: first those
            # that meet most others, as an original does, which its copies are like.
            possible |= possible.T
            for i in np.argsort(-possible.sum(axis=1), kind="stable"):
                others = np.flatnonzero(possible[i] & (label != label[i]))
                possible[i, :] = possible[:, i] = False
                alike = similar([(words[at[i]], words[at[j]]) for j in others], similarity)
                for j in others[alike]:
                    if label[i] != label[j]:
                        yield min(label[i], label[j]), max(label[i], label[j])
                        label[label == label[i]] = label[j]
        alike = similar([(words[i], words[j]) for i, j in waiting], similarity)
        for (i, j), found in zip(waiting, alike, strict=True):
            if found:
                yield min(component[i], component[j]), max(component[i], component[j])

    def linked(batch: pa.RecordBatch, begins: np.ndarray) -> pa.RecordBatch:
        found = sorted(set(links(batch, begins)))
        sides = [pa.array([pair[side] for pair in found], pa.int64()) for side in (0, 1)]
        return pa.RecordBatch.from_arrays(sides, ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last group's rows, of which more may follow: at most two parts
        for batch in text_slices(batches, "words"):
            if held is not None:
                batch = pa.concat_batches([held, batch])
            columns = [batch.column(name).to_numpy() for name in ("key", "low", "high")]
            changes = np.any([column[1:] != column[:-1] for column in columns], axis=0)
            begins = np.concatenate([[0], np.flatnonzero(changes) + 1])
            held = batch.slice(begins[-1])
            if len(begins) > 1:
                yield linked(batch.slice(0, begins[-1]), begins[:-1])
        if held is not None:
            yield linked(held, np.zeros(1, np.int64))

    return run


def sketched_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, content, sketches) of every row, written once; content is null without words."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(
        read.mapInArrow(_sketched, "doc_id long, content string, sketches array<long>"), "sketched-texts"
    )


def groups(docs: DataFrame, sketched: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(content, class_id) of every different text: the least doc_id of its group.

    ``docs`` has doc_id and text, ``sketched`` is ``sketched_texts`` of it. Equal texts, up
    to case and white space, are one node with its least doc_id from the start; null ids
    are left out. Different texts should not share a doc_id, else they count as one
    group. A text without words is in no group. Different texts are never collected:
    candidates, their words and the links stay tables, written where they are used twice.
    """
    classes = written(
        sketched.where("content IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("content")
        .agg(F.min("doc_id").alias("node"), F.first("sketches").alias("sketches")),
        "text-classes",
    )
    # Sketches that more than one text has, with the texts that have them.
    by_sketch = classes.select("node", F.explode("sketches").alias("sketch"))
    shared = (
        by_sketch.groupBy("sketch")
        .agg(F.min("node").alias("least"), F.max("node").alias("most"))
        .where("least <> most")
        .select("sketch")
    )
    buckets = written(by_sketch.join(shared, "sketch").distinct(), "buckets")
    candidates = buckets.select("node").distinct()
    words = written(
        docs.select(F.col("doc_id").cast("long").alias("node"), "text")
        .join(candidates, "node")
        # A repeated row has equal words.
        .groupBy("node")
        .agg(F.min("text").alias("text"))
        .mapInArrow(_with_words, "node long, words binary"),
        "candidate-words",
    )

    leaders = buckets.groupBy("sketch").agg(F.min("node").alias("a"))
    pairs = written(
        buckets.join(leaders, "sketch").where("node <> a").select("a", F.col("node").alias("b")).distinct(),
        "leader-pairs",
    )
    judged = None
    for turn in range(ROUNDS):
        asked = pairs if judged is None else _open(pairs, judged)
        if turn < ROUNDS - 1:
            # At first one leader of each text, as it mostly stands for the others.
            asked = asked.groupBy("b").agg(F.min("a").alias("a"))
        answers = _answers(asked, words, similarity)
        judged = answers if judged is None else judged.union(answers)
    found = components(judged.where("alike").select("a", "b"))
    found = merged(found, _rest(_several(buckets, found), words, similarity))
    return classes.select("content", "node").join(found, "node", "left").select(
        "content", F.coalesce("component", "node").alias("class_id")
    )


def _open(pairs: DataFrame, judged: DataFrame) -> DataFrame:
    """The pairs not judged yet whose texts aren't like one and the same leader."""
    like = judged.where("alike").groupBy("b").agg(F.min("a").alias("leader"))
    return (
        pairs.join(judged.select("a", "b"), ["a", "b"], "left_anti")
        .join(like.select(F.col("b").alias("a"), F.col("leader").alias("of_a")), "a", "left")
        .join(like.select("b", F.col("leader").alias("of_b")), "b", "left")
        .where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b"))
        .select("a", "b")
    )


def _answers(asked: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """(a, b, alike) of the pairs asked."""
    return written(
        asked.join(words.select(F.col("node").alias("b"), F.col("words").alias("b_words")), "b")
        .join(words.select(F.col("node").alias("a"), F.col("words").alias("a_words")), "a")
        .select("a", "b", "a_words", "b_words")
        .mapInArrow(_verified(similarity), "a long, b long, alike boolean"),
        "verified",
    )


def _several(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """(sketch, node, component, size) of the buckets whose texts are in several components.

    Two texts alone have been compared, one being the leader.
    """
    labelled = written(
        buckets.join(found, "node", "left").select(
            "sketch", "node", F.coalesce("component", "node").alias("component")
        ),
        "labelled-buckets",
    )
    several = (
        labelled.groupBy("sketch")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.min("component").alias("least"),
            F.max("component").alias("most"),
        )
        .where("size > 2 AND least <> most")
        .select("sketch", "size")
    )
    return written(labelled.join(several, "sketch"), "buckets-of-several")


def _rest(several: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """Links between the components of each bucket that holds several.

    The texts of a bucket of up to ``WHOLE_PARTS`` parts meet by its sketch, in blocks. Those
    of larger ones meet by their rarest words, so that no bucket is paired up beyond that
    size. Only ``COUNTERS`` counts reach the driver, and the tasks from there.
    """
    texts = written(several.select("node", "component").distinct().join(words, "node"), "open-texts")
    whole = F.col("size") <= WHOLE_PARTS * PART
    agreeing = written(
        several.where(whole)
        .select(F.col("sketch").alias("key"), "node", F.lit(True).alias("own"))
        .union(_rare_meetings(several.where(~whole), texts, similarity)),
        "agreeing-texts",
    )
    met = (
        agreeing.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.bit_xor(F.xxhash64("node", "own")).alias("texts"),
            F.bit_xor(F.xxhash64("node", "own", F.lit(1))).alias("again"),
        )
        # Keys of the same texts count once, told by 128 bits of hash.
        .groupBy("size", "texts", "again")
        .agg(F.min("key").alias("key"))
        .select("key", F.ceil(F.col("size") / PART).alias("parts"))
    )
    # At most as long as the text.
    met_by = agreeing.join(met, "key").groupBy("node").agg(
        F.collect_list(F.struct("key", "own", "parts")).alias("met")
    )
    spread = texts.join(met_by, "node").select(
        "node", "component", "words",
        F.col("met.key").alias("keys"), F.col("met.own").alias("owned"), F.explode("met").alias("by"),
    ).select(
        "*", "by.*", F.pmod(F.xxhash64("node"), F.col("by.parts")).alias("part"),
    )
    meeting = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "key", "component", "words", "keys", "owned", "own", "part",
        F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
    )
    together = ["key", "low", "high"]
    return written(
        meeting.repartition(*together)
        .sortWithinPartitions(*together)
        .mapInArrow(_links_met(similarity), "a long, b long")
        .distinct(),
        "links-between",
    )


def _rare_meetings(several: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(key, node, own) of the rare words by which texts of one bucket of ``several`` meet."""
    nodes = several.select("node").distinct()
    texts = written(texts.join(nodes, "node"), "texts-of-large-buckets")
    totals = (
        texts.select("words")
        .mapInArrow(_counted, "counter long, words long")
        .groupBy("counter")
        .agg(F.sum("words").alias("words"))
        .toPandas()
    )
    counts = np.zeros(COUNTERS, np.int64)
    counts[totals["counter"].to_numpy(np.int64)] = totals["words"]
    # Dealt by key once, for both the sizes and the join with them.
    keys = (
        texts.select("node", "component", "words")
        .mapInArrow(
            _rarest(similarity, counts), "node long, component long, key long, own boolean"
        )
        .repartition("key")
    )
    alive = keys.join(_of_several(keys, "key"), "key")
    # Two texts of a key are candidates where they agree in a sketch as well.
    beside = (
        alive.join(several.select("node", "sketch"), "node")
        .select("key", "node", "component", "own", F.xxhash64("key", "sketch").alias("both"))
        .repartition("both")
    )
    return beside.join(_of_several(beside, "both"), "both").select("key", "node", "own").distinct()


def _of_several(rows: DataFrame, key: str) -> DataFrame:
    """The keys that texts of several components have, one as of its own length class."""
    return (
        rows.groupBy(key)
        .agg(
            F.min("component").alias("least"),
            F.max("component").alias("most"),
            F.max("own").alias("owned"),
        )
        .where("least <> most AND owned")
        .select(key)
    )


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, ``class_id`` and ``kept``.

    ``class_id`` is the least doc_id among a text's near duplicates, and ``kept`` says it
    is the document's own. A document without words (null, empty, white space) or without
    doc_id is a group of its own and kept. Repeated rows fall into one class with equal
    answers. Very long texts are sketched and aligned whole. Other columns are not read;
    an empty table gives no rows.
    """
    sketched = sketched_texts(docs)
    found = groups(docs, sketched, similarity)
    return sketched.drop("sketches").join(found, "content", "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce(F.col("class_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def first_of_each_group(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of every group one row stays, whole.

    It is the row whose doc_id is the group's; among rows that repeat it, the least by
    their other columns. Documents without words or without doc_id all stay. The columns
    are those of ``docs``, whatever their names.
    """
    key = "_content"
    while key in map(str.lower, docs.columns):
        key += "_"
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            contents = pa.array(_contents(*word_hashes(batch.column("text"))), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, contents], [*batch.schema.names, key])

    keyed = docs.mapInArrow(beside, ", ".join([*fields, f"{key} string"]))
    found = groups(docs, sketched_texts(docs), similarity)
    # The class id is the least doc_id of the text that has it, so the pair names one text.
    firsts = found.select(F.col("content").alias(key), F.col("class_id").alias("doc_id"))
    grouped = F.col(key).isNotNull() & F.col("doc_id").isNotNull()
    rows = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    kept = (
        keyed.where(grouped)
        .join(firsts, [key, "doc_id"], "left_semi")
        .groupBy(key, "doc_id")
        .agg(F.min(rows).alias(f"{key}_row"))
        .select(f"{key}_row.*")
    )
    return kept.unionByName(keyed.where(~grouped).drop(key))
