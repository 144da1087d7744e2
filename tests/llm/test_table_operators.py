"""Pairs, near duplicates, search, URL rules and the pipeline against brute force."""

from __future__ import annotations

import math
import random
import re

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from bazaarlake.llm import order_minhash, pivot_topk, projection_dedup
from bazaarlake.llm.alignment import edits_within, may_be_similar, similar
from bazaarlake.llm.components import components
from bazaarlake.llm.preferences import format_pairs, swapped_answers
from bazaarlake.llm.quality_cnn import score_texts, train
from bazaarlake.llm.queries import (
    LLM_ORACLE,
    LLM_QUERIES,
    op2_projection_dedup,
    op3_order_minhash,
    op8_pivot_topk,
)
from bazaarlake.llm.url_rules import judge_urls


def data_folder(name):
    path = TESTDATA / name
    if not path.exists():
        pytest.skip("test data not present")
    return str(path)


def plain(rows):
    return sorted(tuple(str(value) for value in row) for row in rows)


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_matches_sql(spark, sf_small, name):
    con = duckdb.connect()
    for table in ("conversations", "embeddings", "pages", "documents"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_small}/{table}.parquet'")
    found = LLM_QUERIES[name](spark, sf_small)
    columns = sorted(found.columns)
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({LLM_ORACLE[name]})").fetchall()
    assert plain(found.select(*columns).collect()) == plain(expected)


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in LLM_QUERIES) == list(range(1, 14))


TURNS = "pair_id long, turn int, role string, text string, prompt string"


def test_preference_pairs(spark):
    chosen = spark.createDataFrame(
        [(1, 0, "user", "hi", ""), (1, 1, "assistant", "yo", ""), (1, 2, "user", "é?", ""),
         (1, 3, "assistant", "good", ""), (1, 3, "assistant", "good", ""), (2, 0, "user", None, ""),
         (3, 0, "user", "alone", ""), (None, 0, "user", "x", ""), (4, 0, None, "x", "")], TURNS)
    rejected = spark.createDataFrame(
        [(1, 0, "user", "hi", ""), (1, 1, "assistant", "yo", ""), (1, 2, "user", "é?", ""),
         (1, 3, "assistant", "bad", ""), (2, 0, "user", "", ""), (4, 0, "", "x", ""), (4, 5, "assistant", "", "")],
        TURNS)
    rows = {r.pair_id: r for r in format_pairs(chosen, rejected).collect()}
    assert set(rows) == {1, 2, 4}
    assert rows[1].prompt == "<|user|>\nhi\n<|assistant|>\nyo\n<|user|>\né?\n"
    assert (rows[1].chosen, rows[1].rejected) == ("<|assistant|>\ngood\n", "<|assistant|>\nbad\n")
    for row, side in ((rows[1], "chosen"), (rows[1], "rejected")):
        start, end = map(int, row[f"{side}_spans"].split(":"))
        assert row[side][start:end] == {"chosen": "good\n", "rejected": "bad\n"}[side]
    assert (rows[2].chosen, rows[2].rejected, rows[2].prompt_turns) == ("", "", 1)
    assert (rows[4].chosen, rows[4].rejected_spans, rows[4].rejected_turns) == ("", "14:15", 1)
    assert format_pairs(chosen.limit(0), rejected).count() == 0
    sides = swapped_answers(spark.createDataFrame([], "conv_id long, turn int, role string, text string"))
    assert format_pairs(*sides).count() == 0


def components_of(n, pairs):
    label = list(range(n))
    for a, b in pairs:
        x, y = label[a], label[b]
        if x != y:
            label = [min(x, y) if v in (x, y) else v for v in label]
    return label


def test_components_against_brute_force(spark):
    rng = random.Random(2)
    for n in (5, 60):
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(n // 2)] + [(i, i + 1) for i in range(n // 3)]
        links = spark.createDataFrame([*pairs, *pairs[:2], (None, 1)], "a long, b long")
        expected = components_of(n, pairs)
        found = {r.node: r.component for r in components(links).collect()}
        assert found == {v: expected[v] for pair in pairs for v in pair}
    assert components(links.limit(0)).count() == 0


def brute_links(vectors, similarity):
    usable = [
        v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
        for v in vectors
    ]
    pairs = []
    for i, a in enumerate(vectors):
        for j in range(i):
            b = vectors[j]
            if usable[i] and usable[j] and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= similarity:
                    pairs.append((j, i))
    return pairs


def test_near_duplicate_vectors_against_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(30, 16))
    vectors = [list(map(float, b + 0.1 * rng.normal(size=16))) for b in base for _ in range(rng.integers(1, 30))]
    vectors += [vectors[0]] * 20 + [None, [], [0.0] * 16, [math.nan] * 16, [None, 1.0], [1.0, 2.0], [2.0, 4.0]]
    table = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, n_links int")
    vectors = [r.embedding for r in table.orderBy("vec_id").collect()]
    pairs = brute_links(vectors, 0.9)
    expected = components_of(len(vectors), pairs)
    rows = projection_dedup.near_duplicates(table, "vec_id", "embedding").collect()
    assert len(rows) == len(vectors)
    for row in rows:
        assert row.n_links == sum(row.vec_id in pair for pair in pairs)
        assert row.component_id == expected[row.vec_id]
        assert row.kept == (row.vec_id == row.component_id)
    assert projection_dedup.near_duplicates(table.limit(0), "vec_id", "embedding").count() == 0


def test_more_rows_take_more_passes():
    passes = [projection_dedup.passes_for(n) for n in (0, 10, 10**5, 10**7, 10**9)]
    assert passes[0] == projection_dedup.MIN_PASSES and passes == sorted(passes) and passes[-1] < 200


def test_dense_cluster_loses_no_links(spark, monkeypatch):
    """All vectors within a cosine of about 0.85, pairs of 0.92 among them, narrow windows."""
    monkeypatch.setattr(projection_dedup, "WINDOW", 4)
    monkeypatch.setattr(projection_dedup, "BLOCK", 16)
    rng = np.random.default_rng(8)
    size = 256
    noise = rng.normal(size=(600, size)) * math.sqrt(0.15 / 0.85 / size)
    vectors = np.concatenate([rng.normal(size=(1000, size)) / math.sqrt(size), np.eye(size)[0] + noise])
    vectors = np.concatenate([vectors, vectors[1000:1100] + 0.4 * rng.normal(size=(100, size)) / math.sqrt(size)])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    x = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    links = x @ x.T >= 0.9
    np.fill_diagonal(links, False)
    found = projection_dedup.near_duplicates(table, "vec_id", "embedding").agg(F.sum("n_links")).first()[0]
    assert links.sum() > 150 and found >= 0.97 * links.sum()


def test_op2_recall_on_whole_table(spark):
    sf_dir = data_folder("sf0.1")
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], float)
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    links = int((x @ x.T >= 0.9).sum()) - len(x)
    found = op2_projection_dedup(spark, sf_dir).agg(F.count("*"), F.sum("n_links")).first()
    assert found[0] == len(rows) and 0.9 * links <= found[1] <= links


def test_edit_distance_against_full_table():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    rng = random.Random(1)
    pairs, limits = [], []
    for n in range(1200):
        values = rng.choice([2, 5, 50])
        a = [rng.randrange(values) for _ in range(rng.randrange(40 if n % 10 else 300))]
        b = [x for x in a if rng.random() > 0.1]
        for _ in range(rng.randrange(8)):
            b.insert(rng.randrange(len(b) + 1), rng.randrange(values))
        pairs.append((np.array(a, np.uint64), np.array(b, np.uint64)))
        limits.append(rng.randrange(40))
    expected = [distance(a.tolist(), b.tolist()) for a, b in pairs]
    found = edits_within(pairs, limits, [1] * len(pairs))
    assert found == [e if e <= limit else None for e, limit in zip(expected, limits, strict=True)]
    longer = [max(len(a), len(b)) for a, b in pairs]
    alike = [n > 0 and e <= n * 0.2 + 1e-9 for n, e in zip(longer, expected, strict=True)]
    assert similar(pairs, 0.8) == alike
    possible = may_be_similar([a for a, _ in pairs[:100]] + [b for _, b in pairs[:100]], 0.8)
    assert all(possible[n, n + 100] for n in range(100) if alike[n])


def texts_with_copies(rng):
    def words(n):
        return ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 8))) for _ in range(n)]

    shared = words(40)
    texts = []
    for _ in range(25):
        base = words(rng.randrange(30, 200))
        texts.append(base)
        for _ in range(rng.randrange(4)):
            texts.append([w if rng.random() > 0.04 else "zz" for w in base])
        # Half of it is what others have too: no near duplicate.
        texts.append(words(40) + shared)
    return [" ".join(text) for text in texts]


def test_near_duplicate_texts_against_brute_force(spark):
    rng = random.Random(9)
    texts = texts_with_copies(rng)
    texts += [texts[0], texts[0].upper() + " \n", None, "", "   ", "one two", "One  two", "word " * 30000]
    words = [(text or "").lower().split() for text in texts]
    code = {w: i for i, w in enumerate({w for text in words for w in text})}
    hashes = [np.array([code[w] for w in text], np.uint64) for text in words]
    pairs = [(j, i) for i in range(len(texts)) for j in range(i)
             if min(len(hashes[i]), len(hashes[j])) and similar([(hashes[i], hashes[j])], 0.8)[0]]
    expected = components_of(len(texts), pairs)
    docs = spark.createDataFrame(
        [(i, t, "x", 1) for i, t in enumerate(texts)] + [(3, texts[3], "x", 1), (None, texts[5], "x", 1)],
        "doc_id long, text string, _content string, class_id int",
    )
    rows = order_minhash.near_duplicates(docs).collect()
    assert len(rows) == len(texts) + 2
    assert all(row.class_id == expected[row.doc_id] for row in rows if row.doc_id is not None)
    kept = order_minhash.first_of_each_group(docs)
    assert kept.columns == docs.columns
    ids = [row.doc_id for row in kept.collect()]
    groups = {i for i in range(len(texts)) if expected[i] == i}
    assert sorted(i for i in ids if i is not None) == sorted(groups) and ids.count(None) == 1
    assert order_minhash.near_duplicates(docs.limit(0)).count() == 0


def test_left_over_buckets_are_compared_completely(spark, monkeypatch):
    """Buckets whose texts differ from their least one still give all their groups."""
    rng = random.Random(3)
    texts = [[str(rng.randrange(1000)) for _ in range(60)] for _ in range(6)]
    texts = [[*t[:59], str(n)] for n in range(3) for t in texts]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    monkeypatch.setattr(order_minhash, "ROUNDS", 1)
    monkeypatch.setattr(order_minhash, "PART", 4)

    sketched_texts = order_minhash.sketched_texts
    monkeypatch.setattr(
        order_minhash,
        "sketched_texts",
        lambda docs: sketched_texts(docs).withColumn("sketches", F.array(F.lit(7).cast("long"))),
    )
    rows = order_minhash.near_duplicates(docs).collect()
    assert all(row.class_id == row.doc_id % 6 for row in rows)


def test_chains_in_one_bucket_stay_linked(spark):
    """y is only like x, and x is like the bucket's least text, which y differs from."""
    rng = random.Random(4)
    a = [f"a{n}" for n in range(100)]
    x = [w if n >= 15 else f"x{n}" for n, w in enumerate(a)]
    y = [w if n < 85 else f"y{n}" for n, w in enumerate(x)]
    copies = [[*(w if rng.random() > 0.02 else "zz" for w in a), f"c{n}"] for n in range(150)]
    other = [f"b{n}" for n in range(100)]
    texts = [a, *copies, x, y, other]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    sketched = order_minhash.sketched_texts(docs).withColumn("sketches", F.array(F.lit(7).cast("long")))
    found = order_minhash.groups(docs, sketched).groupBy("class_id").count().collect()
    assert {(r.class_id, r["count"]) for r in found} == {(0, len(texts) - 1), (len(texts) - 1, 1)}


def edited(rng, words, share, vocabulary):
    """``words`` after so large a share of random edits."""
    out = list(words)
    for _ in range(int(share * len(words))):
        at = rng.randrange(len(out) + 1)
        match rng.randrange(3):
            case 0 if at < len(out):
                out[at] = rng.choice(vocabulary)
            case 1 if at < len(out):
                del out[at]
            case _:
                out.insert(at, rng.choice(vocabulary))
    return out


@pytest.mark.parametrize("part", [3, 512])
def test_one_bucket_of_all_texts_gives_all_groups(spark, monkeypatch, part):
    """Texts of all lengths about the threshold, many with a passage in common, in blocks and whole."""
    rng = random.Random(part)
    vocabulary = [f"v{n}" for n in range(60)]
    passage = rng.choices(vocabulary, k=40)
    texts = []
    for size in [1, 2, 4, 5, 6, 9, 11, 20, 24, 25, 31, 60, 75, 94, 118] * 2:
        base = rng.choices(vocabulary, k=size)
        texts += [base, *(edited(rng, base, share, vocabulary) for share in (0.05, 0.15, 0.19, 0.2, 0.22))]
        texts.append(passage + rng.choices(vocabulary, k=20))
    texts = [text for text in texts if text]
    code = {w: i for i, w in enumerate(vocabulary)}
    hashes = [np.array([code[w] for w in text], np.uint64) for text in texts]
    pairs = [(j, i) for i in range(len(texts)) for j in range(i) if similar([(hashes[i], hashes[j])], 0.8)[0]]
    expected = components_of(len(texts), pairs)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    monkeypatch.setattr(order_minhash, "PART", part)
    sketched_texts = order_minhash.sketched_texts
    monkeypatch.setattr(
        order_minhash,
        "sketched_texts",
        lambda docs: sketched_texts(docs).withColumn("sketches", F.array(F.lit(7).cast("long"))),
    )
    rows = order_minhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.class_id for r in rows} == dict(enumerate(expected))


def test_open_buckets_make_no_more_rows_than_texts(spark, monkeypatch):
    """Texts of several groups meet by their buckets, not by each bucket times each rare word."""
    rng = random.Random(6)
    vocabulary = [f"v{n}" for n in range(500)]
    base = rng.choices(vocabulary, k=100)
    texts = [edited(rng, base, 0.15, vocabulary) for _ in range(60)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    rows, written = {}, order_minhash.written

    def counted(df, label, *more):
        out = written(df, label, *more)
        rows[label] = out.count()
        return out

    monkeypatch.setattr(order_minhash, "written", counted)
    order_minhash.near_duplicates(docs).collect()
    assert 0 < rows["agreeing-texts"] <= rows["buckets-of-several"] <= rows["buckets"]


def test_op3_on_whole_table(spark, sf_small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    words = {i: text.lower().split() for i, text in docs.items()}
    code = {w: i for i, w in enumerate({w for text in words.values() for w in text})}
    hashes = {i: np.array([code[w] for w in text], np.uint64) for i, text in words.items()}
    ids = sorted(docs)
    place = {i: n for n, i in enumerate(ids)}
    pairs = [(place[b], place[a]) for a in ids for b in ids if b < a and similar([(hashes[a], hashes[b])], 0.8)[0]]
    expected = components_of(len(ids), pairs)
    rows = op3_order_minhash(spark, sf_small).collect()
    assert {r.doc_id: r.class_id for r in rows} == {i: ids[expected[n]] for n, i in enumerate(ids)}


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(6)
    vectors = [list(map(float, v)) for v in rng.normal(size=(700, 8))]
    vectors += [vectors[1]] * 30 + [None, [], [math.inf] * 8, [None] * 8, [1.0, 2.0], [3.0, 4.0]]
    vectors[100] = vectors[1]
    rows = [(i, v, 0) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    whole = {
        r.vec_id: np.floor(1024 * np.array(r.embedding, float)).astype(np.int64)
        for r in table.collect()
        if r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding)
    }
    is_query = (F.col("vec_id") % 100 == 0) | (F.col("vec_id") >= 730)
    found = {}
    for row in pivot_topk.top_k(table, "vec_id", "embedding", is_query).collect():
        found.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    for q in (i for i in whole if i % 100 == 0 or i >= 730):
        scores = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
        expected = [(n, i, -s) for n, (s, i) in enumerate(scores[:10], 1)]
        assert sorted(found.pop(q)) == expected
    assert not found
    assert pivot_topk.top_k(table.limit(0), "vec_id", "embedding", is_query).count() == 0


def test_op8_bounds_skip_blocks_and_lose_nothing(spark):
    sf_dir = data_folder("check_s")
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.floor(1024 * np.array([r.embedding for r in rows], float))
    queries = np.flatnonzero(ids % 100 == 0)
    scores = (x[queries] @ x.T).astype(np.int64)
    scores[np.arange(len(queries)), queries] = -(1 << 62)
    expected = set()
    for n, q in enumerate(queries):
        best = np.lexsort((ids, -scores[n]))[:10]
        expected |= {(int(ids[q]), k, int(ids[b]), int(scores[n, b])) for k, b in enumerate(best, 1)}
    assert {tuple(r) for r in op8_pivot_topk(spark, sf_dir).collect()} == expected


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("a.b.com", "", "block"), ("com", "/x/y", "block"), ("com", "/x", "allow"),
         ("", "/", "block"), (None, "/", "block"), ("com", "/x", "block")]


def test_url_rules_against_brute_force(spark, conf):
    rng = random.Random(8)
    hosts = ["com", "EXAMPLE.com", "www.example.com", "x.www.example.com", "notexample.com", "a.b.com", "b.com",
             "es.net", "", "a..com", "com.", "user@x.com:80", "é.com"]
    paths = ["", "/", "/en/", "/en/1", "/en", "/es/?a", "/x", "/x/y/z", "/x?q=/en/", "#/en/", "/EN/"]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(400)]
    urls += [None, "", "no url", "://", "x://com/x/y", "a\nb://com/x", "http://com/" + "p" * 20000] + urls[:50]
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")

    def judge(url):
        if url is None or "://" not in url:
            return "", "", None, "allow"
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
        fitting = [
            (len(h + p), len(h), h + p, v) for h, p, v in RULES
            if h and (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        best = max(fitting, default=(0, 0, None, "allow"))
        return host, path, best[2], best[3]

    pages = spark.createDataFrame([(i % 300, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    for partitions in ("1", "7"):
        conf(shuffle__partitions=partitions, adaptive__coalescePartitions__enabled="false")
        rows = judge_urls(pages, rules, ["page_id", "url"]).collect()
        assert len(rows) == len(urls)
        assert all((r.host, r.path, r.rule, r.verdict) == judge(r.url) for r in rows)
    assert judge_urls(pages.limit(0), rules, ["page_id"]).count() == 0
    assert judge_urls(pages, rules.limit(0), ["page_id"]).where("verdict <> 'allow'").count() == 0


def test_pipeline(spark, sf_small):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_dedup", "secret_scan", "packing"]
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf_small)
        assert kept.columns == docs.columns
    rows = kept.collect()
    assert 0 < len(rows) == len({r.doc_id for r in rows}) < len(texts)
    assert all(r.text == texts[r.doc_id] or "[SECRET]" in r.text for r in rows)
    pieces = corpus_pipeline.run(spark, sf_small).groupBy("doc_id").agg(F.sum("length"), F.first("doc_tokens")).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in rows}
    assert all(p[1] == p[2] for p in pieces)


def live_places(texts, owners):
    """Where values that fewer than three owners hold stand in each text, from the patterns alone."""
    assign = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = []
    for text in texts:
        base = [(m.start(), m.end(), m[1]) for m in assign.finditer(text) if len(m[1]) >= 8]
        for pattern in ("AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}"):
            base += [(m.start(), m.end(), m[0]) for m in re.finditer(pattern, text)]
        bare = [m for m in re.finditer("[A-Za-z0-9_-]{20,}", text)
                if re.search("[A-Za-z]", m[0]) and len(re.findall("[0-9]", m[0])) >= 3
                and not any(a < m.end() and m.start() < b for a, b, _ in base)]
        found.append([(end, value) for _, end, value in base] + [(m.end(), m[0]) for m in bare])
    holders = {}
    for places, owner in zip(found, owners, strict=True):
        for _, value in places:
            holders.setdefault(value, set()).add(owner)
    return [sorted({(end - len(v), end) for end, v in places if len(holders[v]) < 3}) for places in found]


def mask_found(text, places):
    """Paints characters; a place that meets painted ones widens their placeholder."""
    opens, painted = set(), set()
    for start, end in places:
        if not painted & set(range(start, end)):
            opens.add(start)
        painted |= set(range(start, end))
    return "".join("[SECRET]" if i in opens else "" if i in painted else c for i, c in enumerate(text))


def test_stages_against_brute_force(spark, sf_small):
    """Ids and texts that each stage keeps of its own input."""
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    given = {r.doc_id: r.text for r in docs.collect()}
    network = train(docs, spark.read.parquet(f"{sf_small}/labels.parquet"))
    scores = score_texts(network, [text.encode() for text in given.values()])
    good = {i: text for (i, text), score in zip(given.items(), scores, strict=True) if score >= 0.5}
    assert {r.doc_id: r.text for r in stages["quality_classifier"](spark, docs, sf_small).collect()} == good

    ids = sorted(given)
    words = [given[i].lower().split() for i in ids]
    code = {w: n for n, w in enumerate({w for text in words for w in text})}
    hashes = [np.array([code[w] for w in text], np.uint64) for text in words]
    pairs = [(b, a) for a in range(len(ids)) for b in range(a) if similar([(hashes[a], hashes[b])], 0.8)[0]]
    firsts = {ids[n]: given[ids[n]] for n, c in enumerate(components_of(len(ids), pairs)) if n == c}
    assert {r.doc_id: r.text for r in stages["near_dedup"](spark, docs, sf_small).collect()} == firsts

    own = F.concat("text", F.lit(" token = cD4cD4cD4cD4cD4 see xY5-xY5-xY5-xY5-xY5- again"))
    docs = docs.withColumn("text", F.when(F.col("doc_id") == ids[0], own).otherwise(F.col("text")))
    rows = docs.collect()
    masked = {}
    for row, places in zip(rows, live_places([r.text for r in rows], [r.source for r in rows]), strict=True):
        masked[row.doc_id] = mask_found(row.text, places)
    assert {r.doc_id: r.text for r in stages["secret_scan"](spark, docs, sf_small).collect()} == masked
    assert masked[ids[0]].endswith(" token = [SECRET] see [SECRET] again")


def test_stages_take_empty_tables(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_small).count() == 0
