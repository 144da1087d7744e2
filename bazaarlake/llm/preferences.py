"""Preference pairs rendered for training: one shared prompt, two masked completions.

Turns of the chosen and the rejected conversation are matched by number. Those before
the first that differs are the longest common prefix and become the prompt; what
follows on either side is its completion. Only answers are trained on: the spans say
which characters of a completion count, the rest is masked. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANSWERS = "assistant"


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n"))


def _side(turns: DataFrame, name: str) -> DataFrame:
    """One row per pair and turn; null roles and texts are empty, the least of several stays."""
    said = F.struct(
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return (
        turns.where("pair_id IS NOT NULL AND turn IS NOT NULL")
        .groupBy("pair_id", "turn")
        .agg(F.min(said).alias(name))
    )


def _completion(name: str, answers: str) -> tuple[Column, Column, Column]:
    """Text, trained spans and number of turns of one side behind the prefix."""
    turns = F.filter("turns", lambda x: x[name].isNotNull() & (x["turn"] >= F.col("differs")))
    text = F.array_join(F.transform(turns, lambda x: rendered(x[name]["role"], x[name]["text"])), "")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(done: Column, x: Column) -> Column:
        end = done["at"] + F.length(rendered(x[name]["role"], x[name]["text"]))
        # The answer and its line end are trained on, not the role's mark.
        begin = end - F.length(x[name]["text"]) - 1
        span = F.concat_ws(":", begin, end)
        more = F.when(x[name]["role"] == answers, F.array(span)).otherwise(
            F.array().cast("array<string>")
        )
        return F.struct(end.alias("at"), F.concat(done["spans"], more).alias("spans"))

    spans = F.aggregate(turns, start, step, lambda done: F.array_join(done["spans"], ","))
    return text, spans, F.size(turns).cast("long")


def format_pairs(chosen: DataFrame, rejected: DataFrame, answers: str = ANSWERS) -> DataFrame:
    """One row per pair that has turns on both sides.

    Both inputs have pair_id, turn, role and text; other columns are not read. The
    result has ``prompt``, ``chosen`` and ``rejected`` (rendered), ``chosen_spans`` and
    ``rejected_spans`` (start:end of trained characters in code points, end exclusive,
    comma-joined), and the turns in each part. Two turns are equal if number, role and
    text are; null role or text is empty; rows without pair or turn are left out, and of
    several rows for one turn the least (role, text) stays, so repeated rows change
    nothing. Equal conversations give empty completions, and where one continues the
    other only that one's is not empty. Empty tables give no rows. Turns are spread by
    pair and number until a pair's row, as long as its conversation, is put together.
    """
    both = _side(chosen, "chosen").join(_side(rejected, "rejected"), ["pair_id", "turn"], "full")
    same = F.col("chosen").eqNullSafe(F.col("rejected"))
    pairs = (
        both.groupBy("pair_id")
        .agg(
            F.min(F.when(~same, F.col("turn"))).alias("first"),
            F.max("turn").alias("last"),
            F.count("chosen").alias("n_chosen"),
            F.count("rejected").alias("n_rejected"),
            F.array_sort(F.collect_list(F.struct("turn", "chosen", "rejected"))).alias("turns"),
        )
        .where("n_chosen > 0 AND n_rejected > 0")
        .withColumn("differs", F.coalesce("first", F.col("last") + 1))
    )
    shared = F.filter("turns", lambda x: x["turn"] < F.col("differs"))
    prompt = F.array_join(
        F.transform(shared, lambda x: rendered(x["chosen"]["role"], x["chosen"]["text"])), ""
    )
    columns = ["pair_id", prompt.alias("prompt"), F.size(shared).cast("long").alias("prompt_turns")]
    for name in ("chosen", "rejected"):
        text, spans, turns = _completion(name, answers)
        columns += [text.alias(name), spans.alias(f"{name}_spans"), turns.alias(f"{name}_turns")]
    return pairs.select(*columns)


def swapped_answers(conversations: DataFrame, answers: str = ANSWERS) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns made of a table without judgements.

    Conversations 2k and 2k+1 are mates. A conversation is chosen as it is; rejected is
    the same with its last answer replaced by the mate's last answer. A conversation
    without an answer, or without a mate that has one, is in no pair.
    """
    turns = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    last = (
        turns.where((F.col("role") == answers) & F.col("turn").isNotNull() & F.col("pair_id").isNotNull())
        .groupBy("pair_id")
        .agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("last"))
    )
    mates = last.select(
        F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("last.text").alias("other")
    )
    swaps = last.join(mates, "pair_id").select(
        "pair_id", F.col("last.turn").alias("last_turn"), "other"
    )
    paired = turns.join(swaps, "pair_id")
    swapped = (F.col("turn") == F.col("last_turn")) & (F.col("role") == answers)
    rejected = paired.select(
        "pair_id", "turn", "role", F.when(swapped, F.col("other")).otherwise(F.col("text")).alias("text")
    )
    return paired.select("pair_id", "turn", "role", "text"), rejected
