"""Secrets in texts, judged by how many owners share a value; built-in functions only.

Three base patterns find assignments, access keys and long hexadecimal strings. Every
value found is a candidate. Corpus-wide, candidates are counted by distinct owners and
repositories: a value that many owners hold in many repositories is a copied example, one
of a single owner or two, or of a single shared repository or two, looks live. The counts
also decide over bare tokens, which no keyword introduces: they are added as spans of
their own only if they look live.
"""

from __future__ import annotations

import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.session import written

# Kinds in their order, and the pattern, reported group and least length of each.
BASE_KINDS = {
    "assign": (
        r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        8,
    ),
    "access": (r"(AKIA[A-Z0-9]+)", 1, 16),
    "hex": (r"([0-9a-f]{32,})", 1, 32),
}
BARE_KIND = "token"
BARE_TOKEN = r"([A-Za-z0-9_-]{20,})"
KINDS = [*BASE_KINDS, BARE_KIND]
# A value that so many distinct owners hold, in so many repositories, is a copied example.
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 3
# Prefix sums run over blocks of so many matches.
_BLOCK = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _greatest(values: Column) -> Column:
    return F.coalesce(F.array_max(values), F.lit(0).cast("long"))


def _running(
    steps: Column,
    fold: Callable[[Column], Column] = _total,
    join: Callable[[Column, Column], Column] = operator.add,
) -> Column:
    """What stands before each step, folded: summed, unless said otherwise.

    Whole blocks are folded first, so n steps take n * 256 + (n / 256) squared
    additions and not n squared.
    """

    def totals(blocks: Column, steps: Column) -> Column:
        offsets = F.transform(blocks, lambda _, b: fold(F.slice(blocks, F.lit(1), b)))
        parts = F.transform(
            F.sequence(F.lit(0), F.size(blocks) - 1),
            lambda b: F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK)),
        )
        inside = F.transform(
            F.arrays_zip(offsets.alias("offset"), parts.alias("part")),
            lambda x: _let(
                x["part"],
                lambda part: F.transform(
                    part, lambda _, i: join(x["offset"], fold(F.slice(part, F.lit(1), i)))
                ),
            ),
        )
        return F.flatten(inside)

    def blocks_of(steps: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int")),
            lambda b: fold(F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK))),
        )
        return _let(blocks, lambda found: totals(found, steps))

    return _let(steps, blocks_of)


def find_spans(text: Column, pattern: str, group: int, least: int, kind: str) -> Column:
    """All matches whose ``group`` has ``least`` characters, leftmost and non-overlapping.

    An array of (start, kind_no, end, value); a text without a match is scanned once.
    """
    regex = F.lit(pattern)
    before = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))

    def spans(lengths: Column, gaps: Column) -> Column:
        steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(lengths)), lengths, lambda g, n: g + n)
        found = F.arrays_zip(
            _running(steps).alias("sum"),
            F.slice(gaps, F.lit(1), F.size(lengths)).alias("gap"),
            lengths.alias("length"),
            F.regexp_extract_all(text, regex, F.lit(group)).alias("value"),
        )
        return F.transform(
            F.filter(found, lambda x: F.length(x["value"]) >= least),
            lambda x: F.struct(
                (x["sum"] + x["gap"]).alias("start"),
                F.lit(KINDS.index(kind)).alias("kind_no"),
                (x["sum"] + x["gap"] + x["length"]).alias("end"),
                x["value"].alias("value"),
            ),
        )

    whole = F.regexp_extract_all(text, regex, F.lit(0))
    lengths = F.transform(whole, lambda x: F.length(x).cast("long"))
    kept = _let(lengths, lambda n: _let(before, lambda gaps: spans(n, gaps)))
    none = F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint,value:string>>")
    return F.when(text.rlike(pattern), kept).otherwise(none)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda x: F.concat_ws(":", F.get(names, x["kind_no"]), x["start"], x["end"]),
        ),
        ",",
    )


def with_candidates(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``base`` spans, ``bare`` spans outside of them, and a content key.

    The key is null where there is no candidate, so only texts with some are joined.
    """
    base = F.concat(*[find_spans(text, *spec, kind) for kind, spec in BASE_KINDS.items()])
    bare = F.filter(
        find_spans(text, BARE_TOKEN, 1, 20, BARE_KIND),
        lambda x: x["value"].rlike("[0-9].*[0-9].*[0-9]") & x["value"].rlike("[A-Za-z]"),
    )
    found = docs.withColumns({"base": base, "bare": bare})
    outside = F.filter(
        "bare",
        lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    found = found.withColumn("bare", F.when(F.size("base") == 0, F.col("bare")).otherwise(outside))
    some = F.size("base") + F.size("bare") > 0
    return found.withColumn("content", F.when(some, F.sha2(text, 256)))


def ownership(found: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """(content, owners, repositories by value hash) of every text that has candidates.

    A value is counted once for each owner and repository before it is shuffled, so a
    value in a third of all rows is a few rows. Unknown owners count as one owner.
    """
    values = found.where("content IS NOT NULL").select(
        "content",
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
        F.explode(
            F.array_distinct(
                F.transform(F.concat("base", "bare"), lambda x: F.sha2(x["value"], 256))
            )
        ).alias("hash"),
    )
    holders = values.select("hash", "owner", "repository").distinct()
    spread = holders.groupBy("hash").agg(
        F.count_distinct("owner").alias("owners"),
        F.count_distinct("repository").alias("repositories"),
    )
    return (
        values.select("content", "hash")
        .distinct()
        .join(spread, "hash")
        .groupBy("content")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("hash", "owners"))).alias("owners"),
            F.map_from_entries(F.collect_list(F.struct("hash", "repositories"))).alias(
                "repositories"
            ),
        )
    )


def scan(
    docs: DataFrame,
    columns: list[str],
    owner_column: str = "source",
    repository_column: str = "source",
    example_owners: int = EXAMPLE_OWNERS,
    example_repositories: int = EXAMPLE_REPOSITORIES,
    keep_text: bool = False,
) -> DataFrame:
    """Spans of secrets in every text of ``docs``, beside ``columns``.

    ``spans`` holds (start, kind_no, end, value, owners, repositories, live) by start, then
    kind, in code points with the end exclusive; ``base`` of them come from the base
    patterns, and a bare token is among them only if it is live, that is held by fewer than
    ``example_owners`` owners or in fewer than ``example_repositories`` repositories. A null
    text counts as empty: no spans. Repeated rows each get their spans, and count once per
    owner and repository. Columns not named are not read; ``columns`` named like a result
    are refused. An empty table gives no rows.

    The patterns run once: what they find is written to the shared folder, when this is
    called, and only texts with a candidate are joined with the counts.
    """
    clash = {name.lower() for name in columns} & {"base", "spans", *(["text"] if keep_text else [])}
    if clash:
        raise ValueError(f"columns named like results: {sorted(clash)}")
    text = F.coalesce(F.col("_text"), F.lit(""))
    named = docs.select(
        *[F.col(f"`{name}`").alias(f"_c{i}") for i, name in enumerate(columns)],
        F.col("text").alias("_text"),
        F.col(f"`{owner_column}`").alias("_owner"),
        F.col(f"`{repository_column}`").alias("_repository"),
    )
    found = with_candidates(named, text)
    found = written(found if keep_text else found.drop("_text"), "secret-candidates")
    counts = ownership(found, F.col("_owner"), F.col("_repository"))
    found = found.drop("_owner", "_repository")
    unknown = F.lit(None).cast("map<string,bigint>")
    without = found.where("content IS NULL").withColumns({"owners": unknown, "repositories": unknown})
    some = found.where("content IS NOT NULL").join(counts, "content")
    joined = some.unionByName(without)

    def judged(spans: str) -> Column:
        def held(x: Column, by: str) -> Column:
            return F.col(by)[F.sha2(x["value"], 256)].alias(by)

        def few(x: Column) -> Column:
            few_owners = held(x, "owners") < example_owners
            return few_owners | (held(x, "repositories") < example_repositories)

        return F.transform(
            spans,
            lambda x: F.struct(
                x["start"], x["kind_no"], x["end"], x["value"],
                held(x, "owners"), held(x, "repositories"), few(x).alias("live"),
            ),
        )

    kept = [F.col(f"_c{i}").alias(name) for i, name in enumerate(columns)]
    if keep_text:
        kept.append(F.col("_text").alias("text"))
    return joined.select(
        *kept,
        F.array_sort(judged("base")).alias("base"),
        F.array_sort(
            F.concat(judged("base"), F.filter(judged("bare"), lambda x: x["live"]))
        ).alias("spans"),
    )


def digest(scanned: DataFrame, columns: list[str]) -> DataFrame:
    """Counts and comma-joined spans of ``scan``'s result."""

    def count(kind: str) -> Column:
        number = KINDS.index(kind)
        return F.size(F.filter("base", lambda x: x["kind_no"] == number)).cast("long")

    return scanned.select(
        *columns,
        *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda x: x["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda x: ~x["live"])).cast("long").alias("n_examples"),
    )


def mask(scanned: DataFrame, columns: list[str], placeholder: str = "[SECRET]") -> DataFrame:
    """``columns`` and the text with every live-looking value replaced where it was found.

    A value is the end of its span, so its keyword stays, and so do copied examples and
    the same characters elsewhere in the text, which no pattern took for a secret. Values
    that overlap give one placeholder.
    """
    live = F.filter("spans", lambda x: x["live"])
    places = F.array_sort(
        F.transform(
            live,
            lambda x: F.struct((x["end"] - F.length(x["value"])).alias("start"), x["end"].alias("end")),
        )
    )

    def masked(places: Column) -> Column:
        ends = F.transform(places, lambda x: x["end"])
        # Up to where the places before reach; what lies within that is masked already.
        reached = F.zip_with(
            places,
            _running(ends, _greatest, F.greatest),
            lambda x, before: F.struct(x["start"].alias("start"), before.alias("before")),
        )
        parts = F.transform(
            F.filter(reached, lambda x: x["start"] >= x["before"]),
            lambda x: F.concat(_part(x["before"], x["start"]), F.lit(placeholder)),
        )
        return F.concat(F.array_join(parts, ""), _part(F.array_max(ends), F.length("text")))

    def _part(start: Column, end: Column) -> Column:
        return F.substring(F.col("text"), (start + 1).cast("int"), (end - start).cast("int"))

    text = F.when(F.size(live) == 0, F.col("text")).otherwise(_let(places, masked))
    return scanned.select(*columns, text.alias("text"))


def masked_documents(docs: DataFrame, owner_column: str = "source") -> DataFrame:
    """``docs`` with live-looking secrets masked in ``text`` and ``n_chars`` counted anew.

    Every row and every column stays, whatever the columns are named; a text without a
    live secret is unchanged, a null one becomes empty.
    """
    others = [name for name in docs.columns if name != "text"]
    short = [f"_k{i}" for i in range(len(others))]
    named = docs.select(*[F.col(f"`{n}`").alias(s) for n, s in zip(others, short, strict=True)], "text")
    owner = short[others.index(owner_column)]
    masked = mask(scan(named, short, owner, owner, keep_text=True), short)
    masked = masked.withColumn("text", F.coalesce("text", F.lit("")))
    columns = {n: F.col(s) for n, s in zip(others, short, strict=True)} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast("long")
    return masked.select(*[columns[name].alias(name) for name in docs.columns])
