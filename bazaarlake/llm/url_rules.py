"""Allow and block rules over URLs, by a sorted sweep over reversed-host keys.

A host is written label by label from its end, so a rule of host and path is the prefix
of a key and covers one interval of the sorted keys. A rule also holds for subdomains:
each URL is looked up once for its host and once for every parent domain. Rules and
URL keys are sorted together; a sweep keeps the rules whose interval is open on a stack,
nested ones on top, and gives each key the innermost. What is open where a partition
begins is carried over from the partitions before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import checkpointed

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_AUTHORITY = "(?s)^.*?://([^/?#]*)([^?#]*)"
# Ends a label, and the host, in a key; sorts before every other character.
_END = "\x00"
_KEYS = "key string, kind int, host string, path string, rule string, verdict string"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty without ``://``."""
    host = F.coalesce(F.regexp_extract(url, _AUTHORITY, 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, _AUTHORITY, 2), F.lit(""))
    return F.translate(host, _UPPER, _LOWER), path


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, _END), F.lit(_END + _END), path)


def _rule_keys(rules: DataFrame) -> DataFrame:
    """One row per host and path; where verdicts differ, block wins."""
    host = F.translate("host", _UPPER, _LOWER)
    return (
        rules.where("host <> '' AND path IS NOT NULL AND verdict IS NOT NULL")
        .groupBy(host.alias("host"), "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            _key(F.reverse(F.split("host", r"\.", -1)), F.col("path")).alias("key"),
            F.lit(0).alias("kind"), "host", "path",
            F.concat("host", "path").alias("rule"), "verdict",
        )
    )


def _url_keys(urls: DataFrame) -> DataFrame:
    """A row for the host of each URL and for each parent domain."""
    labels = F.reverse(F.split("host", r"\.", -1))
    depth = F.sequence(F.lit(1), F.size(labels))
    return (
        urls.where("host <> ''")
        .withColumn("depth", F.explode(depth))
        .select(
            _key(F.slice(labels, 1, F.col("depth")), F.col("path")).alias("key"),
            F.lit(1).alias("kind"), "host", "path",
            F.lit(None).cast("string").alias("rule"),
            F.lit(None).cast("string").alias("verdict"),
        )
    )


class OpenRules:
    """The rules whose interval holds the key swept last, outermost first."""

    def __init__(self, rules: list[tuple[str, str, str]]) -> None:
        self.stack = list(rules)  # key, rule, verdict

    def move(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def open(self, key: str, rule: str, verdict: str) -> None:
        self.stack.append((key, rule, verdict))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _left_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per partition: the key it ends with and the rules it opened that hold there."""
    rules, last = OpenRules([]), None
    for key, kind, _, _, rule, verdict in _rows(batches):
        rules.move(key)
        if kind == 0:
            rules.open(key, rule, verdict)
        last = key
    if last is not None:
        yield pa.RecordBatch.from_pydict(
            {
                "part": [TaskContext.get().partitionId()],
                "last": [last],
                "open": [[{"key": k, "rule": r, "verdict": v} for k, r, v in rules.stack]],
            },
            schema=pa.schema(
                [
                    ("part", pa.int32()),
                    ("last", pa.string()),
                    ("open", pa.list_(pa.struct([(n, pa.string()) for n in ("key", "rule", "verdict")]))),
                ]
            ),
        )


def sweep(keys: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of every URL key that lies in a rule's interval.

    The sorted partitions are checkpointed, so both passes see the same ones. The driver
    holds one row per partition, with rules that are prefixes of one key.
    """
    # The other columns split a key that very many rows share.
    order = ["key", "kind", "path", "host"]
    placed = checkpointed(keys.repartitionByRange(*order).sortWithinPartitions(*order))
    ends = placed.mapInArrow(
        _left_open, "part int, last string, open array<struct<key:string,rule:string,verdict:string>>"
    )
    carried: dict[int, list[tuple[str, str, str]]] = {}
    before: list[tuple[str, str, str]] = []
    for row in sorted(ends.collect(), key=lambda r: r.part):
        carried[row.part] = before
        kept = [rule for rule in before if row.last.startswith(rule[0])]
        before = kept + [tuple(rule) for rule in row.open]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = OpenRules(carried.get(TaskContext.get().partitionId(), []))
        schema = pa.schema([(n, pa.string()) for n in ("host", "path", "rule", "verdict")])
        for batch in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            for key, kind, host, path, rule, verdict in _rows(iter([batch])):
                rules.move(key)
                if kind == 0:
                    rules.open(key, rule, verdict)
                elif rules.stack:
                    _, found, judged = rules.stack[-1]
                    for name, value in zip(out, (host, path, found, judged), strict=True):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return placed.mapInArrow(run, "host string, path string, rule string, verdict string")


def judge_urls(
    pages: DataFrame, rules: DataFrame, columns: list[str], default: str = "allow"
) -> DataFrame:
    """``columns`` of every page with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains where
    the page's path starts with the rule's; the longest fitting rule wins, among equally
    long ones that of the longer host. Without a fitting rule ``rule`` is null and the verdict is
    ``default``. A null URL, or one without ``://``, has empty host and path and no rule.
    Rules with a null or an empty host are left out. Repeated pages are judged alike;
    equal URLs are swept once. No other column is read; an empty table gives no rows.
    """
    host, path = url_parts(F.col("_url"))
    named = pages.select(
        *[F.col(f"`{name}`").alias(f"_c{i}") for i, name in enumerate(columns)],
        F.col("url").alias("_url"),
    ).select("*", host.alias("host"), path.alias("path")).drop("_url")
    urls = named.select("host", "path").distinct()
    matched = sweep(_url_keys(urls).unionByName(_rule_keys(rules)))
    rank = F.struct(F.length("rule"), F.length(F.regexp_extract("rule", "^[^/]*", 0)), "rule")
    judged = matched.groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "verdict"), rank).alias("found")
    )
    return named.join(judged, ["host", "path"], "left").select(
        *[F.col(f"_c{i}").alias(name) for i, name in enumerate(columns)],
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.lit(default)).alias("verdict"),
    )
