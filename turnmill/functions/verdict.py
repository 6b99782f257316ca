"""Acceptance rules, stated once over measures that either input shape can supply.

Measures of a normalised conversation: `normalized`, `n_chars` (joined text), `n_stripped`
(joined text without outer whitespace), `n_script`, `has_short`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnmill.config import Limits, Script
from turnmill.functions import messages as ms, text as tx

ACCEPTED = "accepted"
NORMALIZE_FAILED = "normalize_failed"


def measures_of(df: DataFrame, messages: str, script: Script, limits: Limits) -> DataFrame:
    """Add the measures to rows that hold a normalised `messages` column."""
    m = F.col(messages)
    return (
        df.withColumn("_text", ms.joined_text(m))
        .withColumn("normalized", m.isNotNull())
        .withColumn("n_chars", F.length("_text").cast("bigint"))
        .withColumn("n_stripped", F.length(tx.strip(F.col("_text"))).cast("bigint"))
        .withColumn("n_script", tx.script_chars(F.col("_text"), script).cast("bigint"))
        .withColumn(
            "has_short", F.coalesce(ms.has_short_message(m, limits.min_message_chars), F.lit(False))
        )
        .drop("_text")
    )


def _size_checks(script: Script, limits: Limits, chain: Column) -> Column:
    n_tokens = tx.tokens_from_counts(F.col("n_chars"), F.col("n_script"), script)
    return (
        chain.when(n_tokens > limits.max_tokens, "too_long")
        .when(F.col("has_short"), "empty_message")
        .otherwise("ok")
    )


def target_reason(script: Script, limits: Limits) -> Column:
    """First rule broken by a conversation that must hold the script, else `ok`."""
    share = tx.ratio(F.col("n_script"), F.col("n_stripped"))
    chain = F.when(F.col("n_script") == 0, f"no_{script.name}").when(
        share < limits.min_ratio, f"{script.name}_ratio_low"
    )
    return _size_checks(script, limits, chain)


def other_reason(script: Script, limits: Limits) -> Column:
    """First rule broken by a conversation that must not hold the script, else `ok`."""
    return _size_checks(script, limits, F.when(F.col("n_script") > 0, f"has_{script.name}"))


def outcome(rule: Column, script: Script, limits: Limits) -> Column:
    """`accepted`, `normalize_failed` or `invalid_<reason>`, the rule chosen per row."""
    reason = F.when(rule == "target", target_reason(script, limits)).otherwise(
        other_reason(script, limits)
    )
    return (
        F.when(~F.col("normalized"), NORMALIZE_FAILED)
        .when(reason == "ok", ACCEPTED)
        .otherwise(F.concat(F.lit("invalid_"), reason))
    )
