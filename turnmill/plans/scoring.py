"""Scores of model responses: does an answer keep the language of its prompt?"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from turnmill.config import THAI, Script
from turnmill.functions import text as tx


def usable_prompts(prompts: DataFrame, column: str = "prompt") -> DataFrame:
    """Prompts trimmed of outer whitespace, those with nothing left taken out."""
    return prompts.withColumn(column, tx.strip(F.col(column))).filter(F.length(column) > 0)


def score_responses(responses: DataFrame, script: Script = THAI) -> DataFrame:
    """Add the language flags and sizes to `prompt, response, seconds` rows."""
    return responses.withColumns(
        {
            "is_target_prompt": tx.contains_script(F.col("prompt"), script),
            "is_target_response": tx.contains_script(F.col("response"), script),
            "n_chars": F.length("response").cast("bigint"),
            "time_seconds": F.round("seconds", 2),
        }
    )


def score_summary(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts and shares of answers in the prompt's language; NULL where there is no prompt."""
    target, answered = F.col("is_target_prompt"), F.col("is_target_response")
    n, n_target = F.count(F.lit(1)), F.count_if(target)
    kept_target, kept_other = F.count_if(target & answered), F.count_if(~target & ~answered)
    return scored.groupBy(*(by or [])).agg(
        n.alias("n_prompts"),
        n_target.alias("n_target_prompts"),
        (n - n_target).alias("n_other_prompts"),
        F.count_if(answered).alias("n_target_responses"),
        kept_target.alias("target_kept"),
        tx.percent(kept_target, n_target).alias("pct_target_kept"),
        kept_other.alias("other_kept"),
        tx.percent(kept_other, n - n_target).alias("pct_other_kept"),
        # Summed as decimals, so that the mean does not depend on the order of the rows.
        (F.sum(F.col("seconds").cast("decimal(18,6)")).cast("double") / n).alias("mean_seconds"),
    )


def compare(base: DataFrame, adapted: DataFrame) -> DataFrame:
    """Two runs of the same prompts side by side; a prompt may be missing from either."""
    fields = ["is_target_prompt", "is_target_response", "n_chars", "time_seconds"]
    side = lambda df, name: df.select(
        "prompt_id", *[F.col(f).alias(f"{name}_{f}") for f in fields]
    )
    both = side(base, "base").join(side(adapted, "adapted"), "prompt_id", "full_outer")
    kept = lambda name: F.col(f"{name}_is_target_prompt") == F.col(f"{name}_is_target_response")
    return both.select(
        "prompt_id",
        F.coalesce("base_is_target_prompt", "adapted_is_target_prompt").alias("is_target_prompt"),
        kept("base").alias("base_kept"),
        kept("adapted").alias("adapted_kept"),
        "base_n_chars",
        "adapted_n_chars",
        (F.col("adapted_n_chars") - F.col("base_n_chars")).alias("n_chars_delta"),
        (F.col("adapted_time_seconds") - F.col("base_time_seconds")).alias("seconds_delta"),
        F.when(F.col("base_n_chars").isNull(), "adapted_only")
        .when(F.col("adapted_n_chars").isNull(), "base_only")
        .otherwise("both")
        .alias("present"),
    )


def compare_summary(compared: DataFrame) -> DataFrame:
    """Prompts by where they are present, and how many gained or lost their language."""
    base, adapted = F.col("base_kept"), F.col("adapted_kept")
    return compared.groupBy("present").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(base).alias("base_kept"),
        F.count_if(adapted).alias("adapted_kept"),
        F.count_if(~base & adapted).alias("gained"),
        F.count_if(base & ~adapted).alias("lost"),
        F.avg("n_chars_delta").alias("mean_chars_delta"),
    )
