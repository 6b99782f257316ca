"""Conversations stored as one row per turn: `conv_id, turn, role, text`.

A conversation here may be of any length, so nothing below gathers one whole. Rules that depend
on the order of turns are settled in two levels: inside segments of `segment` consecutive turns,
which spread over the cluster, then across the few summary rows of each conversation. Only
conversations accepted under a token limit are ever assembled into arrays, and that limit bounds
their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from turnmill.config import Limits, Script
from turnmill.functions import messages as ms, text as tx
from turnmill.session import materialize

SEGMENT = 1024


def _is_system() -> Column:
    return tx.is_spoken(F.col("text")) & F.coalesce(F.col("role") == "system", F.lit(False))


def _is_kept() -> Column:
    return tx.is_spoken(F.col("text")) & F.coalesce(
        F.col("role").isin("user", "assistant"), F.lit(False)
    )


def _signals(turns: DataFrame, script: Script, segment: int) -> DataFrame:
    """What the rules need of each turn, as numbers; the text goes no further than the scan."""
    text = F.col("text")
    return turns.select(
        "conv_id",
        "turn",
        F.expr(f"turn div {segment}").alias("seg"),
        _is_system().alias("is_system"),
        F.when(_is_kept(), F.col("role") == "user").alias("is_user"),
        F.coalesce(F.length(text), F.lit(0)).cast("bigint").alias("chars"),
        tx.leading_blanks(text).cast("bigint").alias("lead"),
        tx.trailing_blanks(text).cast("bigint").alias("trail"),
        tx.script_chars(text, script).cast("bigint").alias("script"),
    )


def _segment_summaries(signals: DataFrame, limits: Limits) -> DataFrame:
    before = (
        Window.partitionBy("conv_id", "seg")
        .orderBy("turn")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # `at`: turn of a kept message. `opening`: turn of a system message with none kept before it.
    # `reach`: length without the blanks at the end.
    return (
        signals.withColumn("prev", F.last("is_user", ignorenulls=True).over(before))
        .selectExpr(
            "*",
            "chars - trail as reach",
            "if(is_user is not null, turn, null) as at",
            "if(is_system and prev is null, turn, null) as opening",
        )
        .groupBy("conv_id", "seg")
        .agg(
            *map(
                F.expr,
                (
                    "count(1) as turns",
                    "count(at) as kept",
                    "sum(chars) filter (where at is not null) as chars",
                    "sum(script) filter (where at is not null) as script",
                    f"count_if(at is not null and reach - lead < {limits.min_message_chars})"
                    " as short",
                    "count_if(is_user = prev) as repeats",
                    "min(at) as first_turn",
                    "max(at) as last_turn",
                    "min_by(is_user, at) as first_is_user",
                    "min_by(reach, at) as first_reach",
                    "min_by(lead, at) as first_lead",
                    "max_by(is_user, at) as last_is_user",
                    "max_by(trail, at) as last_trail",
                    "max(opening) as system_turn",
                    "max_by(chars, opening) as system_chars",
                    "max_by(lead, opening) as system_lead",
                    "max_by(script, opening) as system_script",
                ),
            )
        )
    )


def _conversation_summaries(segments: DataFrame) -> DataFrame:
    before = (
        Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        segments.withColumn("prev", F.last("last_is_user", ignorenulls=True).over(before))
        .selectExpr("*", "if(prev is null, system_turn, null) as opening")
        .groupBy("conv_id")
        .agg(
            *map(
                F.expr,
                (
                    "sum(turns) as turns",
                    "sum(kept) as kept",
                    "coalesce(sum(chars), 0) as chars",
                    "coalesce(sum(script), 0) as script",
                    "sum(short) as short",
                    "sum(repeats) + count_if(first_is_user = prev) as repeats",
                    "min(first_turn) as first_turn",
                    "min_by(first_is_user, first_turn) as first_is_user",
                    "min_by(first_reach, first_turn) as first_reach",
                    "min_by(first_lead, first_turn) as first_lead",
                    "max_by(last_is_user, last_turn) as last_is_user",
                    "max_by(last_trail, last_turn) as last_trail",
                    "max(opening) as system_turn",
                    "max_by(system_chars, opening) as system_chars",
                    "max_by(system_lead, opening) as system_lead",
                    "max_by(system_script, opening) as system_script",
                ),
            )
        )
    )


def conversation_facts(
    turns: DataFrame, script: Script, limits: Limits = Limits(), segment: int = SEGMENT
) -> DataFrame:
    """One narrow row per conversation: whether it normalises, and the measures of its
    normalised text (`functions.verdict`), plus `first_turn` and `system_turn`, the turns that
    make up its first message."""
    summary = _conversation_summaries(
        _segment_summaries(_signals(turns, script, segment), limits)
    )
    merged = "system_turn is not null"
    first_is_short = f"first_reach - first_lead < {limits.min_message_chars}"
    return summary.selectExpr(
        "*",
        f"chars + kept - 1 + if({merged}, system_chars + 2, 0) as n_chars",
        f"short - cast({first_is_short} as int) as short_later",
        f"if({merged}, system_chars - system_lead + 2 + first_reach, first_reach - first_lead)"
        " as opening_chars",
    ).selectExpr(
        "conv_id",
        "turns as n_turns",
        "kept as n_messages",
        "first_turn",
        "if(first_turn is not null, system_turn, null) as system_turn",
        "coalesce(kept >= 2 and first_is_user and not last_is_user and repeats = 0, false)"
        " as normalized",
        "n_chars",
        f"n_chars - if({merged}, system_lead, first_lead) - last_trail as n_stripped",
        f"script + if({merged}, system_script, 0) as n_script",
        f"coalesce(short_later > 0 or opening_chars < {limits.min_message_chars}, false)"
        " as has_short",
    )


def normalized_turns(turns: DataFrame, facts: DataFrame) -> DataFrame:
    """The normalised conversations, still one row per message: `conv_id, turn, role, content`.

    `facts` has one row per conversation, so texts are shuffled once, for a one-to-many join
    whose long conversations the skew-join rule can split. Two joins need it, so it is stored.
    """
    good = materialize(
        facts.filter("normalized").select("conv_id", "first_turn", "system_turn"), "normal"
    )
    systems = (
        turns.filter(_is_system())
        .select("conv_id", F.col("turn").alias("system_turn"), F.col("text").alias("system"))
        .join(good.filter("system_turn is not null"), ["conv_id", "system_turn"])
        .select("conv_id", "system")
    )
    openers = good.select("conv_id", "first_turn").join(systems, "conv_id", "left")
    merged = F.col("system").isNotNull() & (F.col("turn") == F.col("first_turn"))
    return (
        turns.filter(_is_kept())
        .join(openers, "conv_id")
        .select(
            "conv_id",
            "turn",
            "role",
            F.when(merged, F.concat(F.col("system"), F.lit("\n\n"), F.col("text")))
            .otherwise(F.col("text"))
            .alias("content"),
        )
    )


def openings(turns: DataFrame, facts: DataFrame, n: int) -> DataFrame:
    """The first `n` characters of each normalised conversation: `conv_id, opening`.

    `n` characters of the system text and of the first user text hold them, so no more of any
    text is shuffled.
    """
    # At most two rows per conversation, so the last group below is bounded.
    places = (
        facts.filter("normalized")
        .select("conv_id", "first_turn", F.explode(F.array("system_turn", "first_turn")).alias("turn"))
        .filter("turn is not null")
    )
    starts = turns.filter(F.col("role").isin("user", "system")).select(
        "conv_id", "turn", F.substring("text", 1, n).alias("start")
    )
    is_first = F.col("turn") == F.col("first_turn")
    return (
        starts.join(places, ["conv_id", "turn"])
        .groupBy("conv_id")
        .agg(
            F.max(F.when(~is_first, F.col("start"))).alias("_system"),
            F.max(F.when(is_first, F.col("start"))).alias("_user"),
        )
        .select(
            "conv_id", F.substring(F.concat_ws("\n\n", "_system", "_user"), 1, n).alias("opening")
        )
    )


def assemble(turns: DataFrame, chosen: DataFrame) -> DataFrame:
    """Add `messages` to `chosen`, accepted conversations with `system_turn`.

    Acceptance bounds each group: every message gathered has at least one character of a text
    that stays within the token limit.
    """
    wanted = _is_kept() | (F.col("turn") == F.col("system_turn"))
    message = F.struct("turn", F.col("role"), F.col("text").alias("content"))
    first = F.try_element_at("_all", F.lit(1))
    kept = F.filter("_all", lambda x: x["role"] != "system")
    numbered = F.transform(
        kept,
        lambda x, i: F.struct(
            i.alias("pos"), x["role"].alias("role"), x["content"].alias("content")
        ),
    )
    # The other columns depend on conv_id; as grouping keys they spare a second join.
    return (
        turns.join(chosen, "conv_id")
        .filter(wanted)
        .groupBy(*chosen.columns)
        .agg(F.sort_array(F.collect_list(message)).alias("_all"))
        .withColumn("_system", F.when(first["role"] == "system", first["content"]))
        .withColumn("_kept", numbered)
        .withColumn("messages", ms.merge_opening(F.col("_kept"), F.col("_system")))
        .select(*chosen.columns, "messages")
    )
