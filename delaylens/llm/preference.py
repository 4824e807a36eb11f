"""Preference formatting: a chosen and a rejected conversation with one prompt.

The longest common prefix of turns is rendered once, as the prompt; what remains
of either side is its completion, with the spans of the text that counts in
training: the assistant's turns and their end marks. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of a turn.
START, BREAK, STOP = "<|im_start|>", "\n", "<|im_end|>"
ASSISTANT = "assistant"


def turns_of(rows: DataFrame, by: list[str], turn: str, role: str, text: str, *extra: Column) -> DataFrame:
    """One row per `by` with `turns`, in order of turn, then role and text. Null
    roles and texts are empty; rows repeated in all of these count once. A
    conversation's turns are one row, as they are in the result."""
    entry = F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    return rows.groupBy(*by).agg(F.sort_array(F.collect_set(entry)).alias("turns"), *extra)


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit(BREAK), turn["text"], F.lit(STOP + "\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def trained_spans(turns: Column) -> Column:
    """[start, end) of the assistant's texts with their end marks, in characters
    of the rendered turns."""
    span = "struct<start:bigint,end:bigint>"
    first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def add(so_far: Column, turn: Column) -> Column:
        start = so_far["at"] + F.length(turn["role"]) + len(START + BREAK)
        end = start + F.length(turn["text"]) + len(STOP)
        own = F.array(F.struct(start.cast("long").alias("start"), end.cast("long").alias("end")))
        spans = F.when(turn["role"] == ASSISTANT, F.concat(so_far["spans"], own)).otherwise(so_far["spans"])
        return F.struct((end + 1).cast("long").alias("at"), spans.alias("spans"))

    return F.aggregate(turns, first, add, lambda s: s["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns with equal role and text."""
    shorter = F.least(F.size(a), F.size(b))
    places = F.when(shorter > 0, F.sequence(F.lit(0), shorter - 1)).otherwise(F.array().cast("array<int>"))
    same = F.transform(places, lambda i: (F.get(a, i)["role"] == F.get(b, i)["role"]) & (F.get(a, i)["text"] == F.get(b, i)["text"]))
    differs = F.array_position(same, False)
    return F.when(differs > 0, (differs - 1).cast("int")).otherwise(shorter)


def format_pairs(pairs: DataFrame, key: str) -> DataFrame:
    """From one row per pair with `chosen` and `rejected` (arrays of turn, role,
    text): key, n_prompt_turns, prompt, chosen, rejected, chosen_spans and
    rejected_spans; the spans count from the completion's start.

    Null arrays are empty conversations; equal sides have everything in the
    prompt and empty completions. Repeated rows stay."""
    empty = F.array().cast(pairs.schema["chosen"].dataType)
    sides = pairs.select(key, F.coalesce("chosen", empty).alias("c"), F.coalesce("rejected", empty).alias("r"))
    split = sides.withColumn("n_prompt_turns", common_turns(F.col("c"), F.col("r")))

    def rest(side: str) -> Column:
        return F.slice(side, F.col("n_prompt_turns") + 1, F.size(side))

    return split.select(key, "n_prompt_turns", F.slice("c", 1, F.col("n_prompt_turns")).alias("p"), rest("c").alias("c"), rest("r").alias("r")).select(
        key,
        "n_prompt_turns",
        render(F.col("p")).alias("prompt"),
        render(F.col("c")).alias("chosen"),
        render(F.col("r")).alias("rejected"),
        trained_spans(F.col("c")).alias("chosen_spans"),
        trained_spans(F.col("r")).alias("rejected_spans"),
    )


def swapped_replies(conversations: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """Preference pairs from plain conversations: (key, chosen, rejected). Every
    conversation with an assistant's turn is chosen; its rejected form has the
    last reply of the neighbour conversation (the id with its lowest bit flipped)
    in place of its own last reply, or an empty one if that has none. Rows without
    a key are left out."""
    whole = turns_of(conversations.where(F.col(key).isNotNull()), [key], turn, role, text)
    last = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == ASSISTANT, i)))
    ending = whole.withColumn("last", last).where("last is not null")
    replies = ending.select(F.col(key).bitwiseXOR(F.lit(1)).alias(key), F.get("turns", F.col("last"))["text"].alias("reply"))
    # replies are narrow next to the conversations; both are dealt by the key
    paired = ending.join(replies, key, "left")
    swapped = F.transform(
        "turns",
        lambda t, i: F.struct(t["turn"].alias("turn"), t["role"].alias("role"), F.when(i == F.col("last"), F.coalesce("reply", F.lit(""))).otherwise(t["text"]).alias("text")),
    )
    return paired.select(key, F.col("turns").alias("chosen"), swapped.alias("rejected"))


def span_text(spans: Column) -> Column:
    """Spans as start-end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(formatted: DataFrame, key: str) -> DataFrame:
    """The formatted texts as SHA-256, the spans as text."""
    texts = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("prompt", "chosen", "rejected")]
    masks = [span_text(F.col(f"{c}_spans")).alias(f"{c}_spans") for c in ("chosen", "rejected")]
    return formatted.select(key, F.col("n_prompt_turns").cast("long").alias("n_prompt_turns"), *texts, *masks)
