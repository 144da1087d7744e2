"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import order_minhash, secret_scan
from bazaarlake.llm.bpe_trie import encode_and_decode
from bazaarlake.llm.common import table
from bazaarlake.llm.html_text import extract
from bazaarlake.llm.packing import pack
from bazaarlake.llm.pivot_topk import top_k
from bazaarlake.llm.preferences import format_pairs, swapped_answers
from bazaarlake.llm.projection_dedup import near_duplicates
from bazaarlake.llm.quality_cnn import classify, held_out, train
from bazaarlake.llm.token_counts import count_tokens
from bazaarlake.llm.turn_repair import repair
from bazaarlake.llm.url_rules import judge_urls
from bazaarlake.llm.whitening import whiten

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def op1_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_pairs(*swapped_answers(table(spark, sf_dir, "conversations")))


OP1_SQL = r"""
WITH last AS (
    SELECT conv_id, max(turn) AS last_turn FROM conversations
    WHERE role = 'assistant' GROUP BY conv_id),
answer AS (
    SELECT conv_id, last_turn, max(coalesce(text, '')) AS answer
    FROM conversations JOIN last USING (conv_id)
    WHERE turn = last_turn AND role = 'assistant' GROUP BY ALL),
swap AS (
    SELECT a.conv_id, a.last_turn, b.answer AS other
    FROM answer a JOIN answer b ON b.conv_id = xor(a.conv_id, 1)),
sides AS (
    SELECT conv_id AS pair_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS chosen,
           CASE WHEN turn = last_turn AND role = 'assistant' THEN other
                ELSE coalesce(text, '') END AS rejected
    FROM conversations JOIN swap USING (conv_id) WHERE turn IS NOT NULL),
cut AS (
    SELECT pair_id, coalesce(min(turn) FILTER (chosen <> rejected), max(turn) + 1) AS differs
    FROM sides GROUP BY pair_id),
marked AS (
    SELECT pair_id, turn, role, turn < differs AS shared,
           '<|' || role || '|>' || chr(10) AS mark, chosen || chr(10) AS said,
           rejected || chr(10) AS refused
    FROM sides JOIN cut USING (pair_id)),
placed AS (
    SELECT *, sum(length(mark) + length(said)) OVER w AS chosen_end,
           sum(length(mark) + length(refused)) OVER w AS rejected_end
    FROM marked
    WINDOW w AS (PARTITION BY pair_id, shared ORDER BY turn))
SELECT pair_id,
       coalesce(string_agg(mark || said, '' ORDER BY turn) FILTER (shared), '') AS prompt,
       count(*) FILTER (shared) AS prompt_turns,
       coalesce(string_agg(mark || said, '' ORDER BY turn) FILTER (NOT shared), '') AS chosen,
       coalesce(string_agg((chosen_end - length(said))::BIGINT || ':' || chosen_end::BIGINT, ','
                           ORDER BY turn) FILTER (NOT shared AND role = 'assistant'), '')
           AS chosen_spans,
       count(*) FILTER (NOT shared) AS chosen_turns,
       coalesce(string_agg(mark || refused, '' ORDER BY turn) FILTER (NOT shared), '') AS rejected,
       coalesce(string_agg((rejected_end - length(refused))::BIGINT || ':' || rejected_end::BIGINT,
                           ',' ORDER BY turn) FILTER (NOT shared AND role = 'assistant'), '')
           AS rejected_spans,
       count(*) FILTER (NOT shared) AS rejected_turns
FROM placed GROUP BY pair_id
"""


def op2_projection_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_BPE)
    return encode_and_decode(table(spark, sf_dir, "documents"), path, ["doc_id"], digest=True)


def op5_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = train(docs, table(spark, sf_dir, "labels"))
    return classify(docs, network, ["doc_id"]).select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


# The rules that pages are judged by.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules, ["page_id"])


OP6_SQL = r"""
WITH parts AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
           row_number() OVER () AS page
    FROM pages),
rules(rule_host, rule_path, rule_verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
           ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'),
           ('net', '/fr/', 'block')),
best AS (
    SELECT page, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           arg_max(rule_verdict, length(rule_host || rule_path)) AS verdict
    FROM parts JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best USING (page)
"""


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = secret_scan.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    return secret_scan.digest(scanned, ["doc_id"])


def _either_case(words: str) -> str:
    """Letters in either case, as classes: RE2's case folding reaches beyond ASCII."""
    return re.sub("[a-z]", lambda letter: f"[{letter[0]}{letter[0].upper()}]", words)


def _op7_sql() -> str:
    """The same spans from what stands between matches, and the owners of each value."""
    assign = (
        f"({_either_case('password|passwd|secret|token|api_?key')})"
        r"""[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"""
    )
    kinds = [
        ("assign", assign, 2, "length(value) >= 8"),
        ("access", "(AKIA[A-Z0-9]+)", 1, "length(value) >= 16"),
        ("hex", "([0-9a-f]+)", 1, "length(value) >= 32"),
        ("token", "([A-Za-z0-9_-]+)", 1,
         "length(value) >= 20 AND regexp_matches(value, '[A-Za-z]')"
         " AND regexp_matches(value, '[0-9].*[0-9].*[0-9]')"),
    ]
    found = "\nUNION ALL\n".join(
        f"""SELECT row, {number} AS kind_no, '{kind}' AS kind, value, begins,
                   begins + length(matches[i]) AS ends
            FROM (SELECT row, i, matches, values[i] AS value,
                         list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                         + coalesce(list_sum(list_transform(matches[1:i - 1], lambda x: length(x))), 0)
                           AS begins
                  FROM (SELECT *, unnest(range(1, len(matches) + 1)) AS i
                        FROM (SELECT row, regexp_extract_all(text, '{pattern}') AS matches,
                                     regexp_extract_all(text, '{pattern}', {group}) AS values,
                                     string_split_regex(text, '{pattern}') AS gaps
                              FROM docs)))
            WHERE {kept}"""
        for number, (kind, pattern, group, kept) in enumerate(kinds)
    )
    return f"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner,
           row_number() OVER () AS row
    FROM documents),
every_span AS ({found}),
spans AS (
    SELECT * FROM every_span AS s
    WHERE kind <> 'token' OR NOT EXISTS (
        SELECT 1 FROM every_span AS b
        WHERE b.row = s.row AND b.kind <> 'token' AND b.begins < s.ends AND s.begins < b.ends)),
spread AS (
    SELECT value, COUNT(DISTINCT owner) < 3 AS live FROM spans JOIN docs USING (row) GROUP BY value),
judged AS (
    SELECT *, kind || ':' || begins::BIGINT || ':' || ends::BIGINT AS span
    FROM spans JOIN spread USING (value) WHERE kind <> 'token' OR live),
summed AS (
    SELECT row, COUNT(*) FILTER (kind = 'assign') AS n_assign,
           COUNT(*) FILTER (kind = 'access') AS n_access, COUNT(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(span, ',' ORDER BY begins, kind_no) FILTER (kind <> 'token') AS base,
           string_agg(span, ',' ORDER BY begins, kind_no) AS spans,
           COUNT(*) FILTER (live) AS n_live, COUNT(*) FILTER (NOT live) AS n_examples
    FROM judged GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
       coalesce(n_examples, 0) AS n_examples
FROM docs LEFT JOIN summed USING (row)
"""


def op8_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_query = F.col("vec_id") % 100 == 0
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", is_query)


OP8_SQL = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score
FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 10
"""


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_BPE)
    return pack(table(spark, sf_dir, "documents"), path, ["doc_id"], with_ids=False)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by the hash of each turn's name."""
    turns = conversations.withColumns(
        {
            "hash": F.crc32(
                F.concat_ws(
                    ":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
                )
            )
            % 20,
            "role": F.coalesce("role", F.lit(" ")),
            "text": F.coalesce("text", F.lit(" ")),
        }
    )
    copies = F.array_repeat(F.lit(0), F.when(F.col("hash") == 3, 2).otherwise(1))
    return (
        turns.where("hash <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("hash") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("hash") == 1, "")
            .when(F.col("hash") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(copies).alias("copy"),
        )
        .drop("copy")
    )


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair(damaged(conversations), conversations=conversations, edits=False)


OP12_SQL = r"""
WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':'
                                       || coalesce(turn::VARCHAR, ' '), ''),
                          lambda x: ascii(x)::BIGINT) AS name
    FROM conversations),
hashed AS (
    SELECT *, xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, name),
               lambda crc, x: list_reduce(
                   list_prepend(xor(crc, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                   lambda c, bit: xor(c >> 1, (c & 1) * 3988292384)))) % 20 AS hash
    FROM named),
faulty AS (
    SELECT conv_id, turn, CASE hash WHEN 4 THEN 'user' ELSE role END AS role,
           CASE hash WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                ELSE text END AS text,
           unnest(range(CASE hash WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM hashed WHERE hash <> 0),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS spot,
           rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown
    FROM faulty),
judged AS (
    SELECT *, role[1:1] AS initial,
           lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY spot) AS initial_before,
           CASE WHEN shown = '' THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY spot) > 1 THEN 'duplicate'
                WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated'
                ELSE 'sound' END AS fault
    FROM placed),
sizes AS (SELECT conv_id, count(*) AS n FROM judged GROUP BY conv_id),
-- From the last turn to the first: the cheapest edits from each state, and their letters.
-- States: at the start, after a system turn (s), after a user's (u), an assistant's (a).
way AS (
    SELECT conv_id, n AS spot, {'c': 0, 'l': ''} AS start, {'c': 4, 'l': 'II'} AS s,
           {'c': 2, 'l': 'I'} AS u, {'c': 0, 'l': ''} AS a
    FROM sizes
    UNION ALL
    SELECT conv_id, spot,
           least(start, {'c': 2 + u2.c, 'l': 'I' || u2.l}), least(s, {'c': 2 + u2.c, 'l': 'I' || u2.l}), u2, a2
    FROM (
        SELECT *, least(u, {'c': 2 + a.c, 'l': 'I' || a.l}) AS u2,
               least(a, {'c': 2 + u.c, 'l': 'I' || u.l}) AS a2
        FROM (
            SELECT conv_id, w.spot - 1 AS spot,
                   least({'c': 3 + start.c, 'l': 'D' || start.l},
                         {'c': CASE WHEN gone THEN 1000000 ELSE 2 + cut + u.c END, 'l': 'R' || u.l},
                         {'c': CASE WHEN gone OR initial <> 'u' THEN 1000000 ELSE cut + u.c END, 'l': 'K' || u.l},
                         {'c': CASE WHEN gone OR initial <> 's' THEN 1000000 ELSE cut + s.c END, 'l': 'K' || s.l}) AS start,
                   least({'c': 3 + s.c, 'l': 'D' || s.l},
                         {'c': CASE WHEN gone THEN 1000000 ELSE 2 + cut + u.c END, 'l': 'R' || u.l},
                         {'c': CASE WHEN gone OR initial <> 'u' THEN 1000000 ELSE cut + u.c END, 'l': 'K' || u.l}) AS s,
                   least({'c': 3 + u.c, 'l': 'D' || u.l},
                         {'c': CASE WHEN gone THEN 1000000 ELSE 2 + cut + a.c END, 'l': 'R' || a.l},
                         {'c': CASE WHEN gone OR initial <> 'a' THEN 1000000 ELSE cut + a.c END, 'l': 'K' || a.l}) AS u,
                   least({'c': 3 + a.c, 'l': 'D' || a.l},
                         {'c': CASE WHEN gone THEN 1000000 ELSE 2 + cut + u.c END, 'l': 'R' || u.l},
                         {'c': CASE WHEN gone OR initial <> 'u' THEN 1000000 ELSE cut + u.c END, 'l': 'K' || u.l}) AS a
            FROM way w JOIN (
                SELECT conv_id AS conv, spot AS place, initial, fault IN ('blank', 'duplicate') AS gone,
                       CASE fault WHEN 'truncated' THEN 1 ELSE 0 END AS cut
                FROM judged) j
              ON j.place = w.spot AND j.conv IS NOT DISTINCT FROM w.conv_id))),
best AS (SELECT conv_id, start.c AS cost, start.l AS audit FROM way WHERE spot = 0),
edits AS (
    SELECT conv_id, unnest(range(1, len(audit) + 1)) AS i, audit FROM best),
lettered AS (
    SELECT conv_id, i, audit[i] AS letter,
           len(replace(audit[1:i], 'I', '')) AS spot, len(replace(audit[1:i], 'D', '')) AS said
    FROM edits),
opened AS (
    SELECT l.conv_id, 1 AS system
    FROM lettered l JOIN judged j ON j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.spot = l.spot
    WHERE l.said = 1 AND letter = 'K' AND initial = 's'),
repaired AS (
    SELECT l.conv_id, string_agg(
        CASE WHEN letter = 'K' THEN role
             WHEN (said - coalesce(system, 0)) % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || CASE letter WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS lines
    FROM lettered l
    LEFT JOIN opened o ON o.conv_id IS NOT DISTINCT FROM l.conv_id
    LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.spot = l.spot
    WHERE letter <> 'D' GROUP BY l.conv_id),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (initial_before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    return count_tokens(table(spark, sf_dir, "documents"), path, ["doc_id"])


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_preferences": op1_preferences,
    "op2_projection_dedup": op2_projection_dedup,
    "op3_order_minhash": op3_order_minhash,
    "op4_bpe_trie": op4_bpe_trie,
    "op5_quality_cnn": op5_quality_cnn,
    "op6_url_rules": op6_url_rules,
    "op7_secret_scan": op7_secret_scan,
    "op8_pivot_topk": op8_pivot_topk,
    "op9_html_text": op9_html_text,
    "op10_packing": op10_packing,
    "op11_whitening": op11_whitening,
    "op12_turn_repair": op12_turn_repair,
    "op13_token_counts": op13_token_counts,
}

LLM_ORACLE: dict[str, str] = {
    "op1_preferences": OP1_SQL,
    "op6_url_rules": OP6_SQL,
    "op7_secret_scan": _op7_sql(),
    "op8_pivot_topk": OP8_SQL,
    "op12_turn_repair": OP12_SQL,
}
