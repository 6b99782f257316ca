"""Quota sampling per tier: the first accepted rows of a seeded order, and the rows looked at."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from turnmill.config import TIERS, Tier, tier_targets
from turnmill.functions.verdict import ACCEPTED
from turnmill.operators.order import cutoffs, small_side, within_cut


def quota_table(
    spark: SparkSession, total: int, tiers: tuple[Tier, ...] = TIERS
) -> DataFrame:
    """`tier, tier_no, rule, target`. A caller may bring a table of its own, of any size."""
    targets = tier_targets(total, tiers)
    return spark.createDataFrame(
        [(t.name, t.number, t.rule, targets[t.name]) for t in tiers],
        "tier string, tier_no int, rule string, target bigint",
    )


def quota_cuts(verdicts: DataFrame, ident: str = "conv_id") -> DataFrame:
    """`tier, k, cut`: the cutoff of each tier with accepted rows, from stored verdicts. To be
    broadcast if small."""
    accepted = verdicts.filter(F.col("outcome") == ACCEPTED)
    cuts = cutoffs(accepted, ["tier", "target"], "draw_key", [ident], F.col("target"))
    return small_side(cuts.select("tier", "k", "cut"))


def apply_quota(verdicts: DataFrame, cuts: DataFrame, ident: str = "conv_id") -> DataFrame:
    """Add `scanned` and `selected` to `verdicts` (`ident, tier, target, outcome, draw_key`).

    A tier is scanned in draw order until `target` rows are accepted. Its cutoff comes from a join
    with one narrow row per tier. Without an accepted row there is no cutoff: all rows
    were looked at, unless none was wanted.
    """
    scanned = within_cut("draw_key", [ident], F.col("target"))
    return (
        verdicts.join(cuts, "tier", "left")
        .withColumn("scanned", scanned)
        .withColumn("selected", F.col("scanned") & (F.col("outcome") == ACCEPTED))
        .drop("cut", "k")
    )


def exact_split(
    rows: DataFrame,
    share: float,
    key: str = "split_key",
    idents: tuple[str, ...] = ("conv_id",),
) -> DataFrame:
    """Add `split` to stored rows: exactly `int(n * share)` are `eval`, the first in `key` order."""
    k = F.floor(F.col("n_rows") * F.lit(float(share)))
    # One row, or none for an empty table, in which case there is nothing to mark either.
    cuts = cutoffs(rows, [], key, list(idents), k)
    inside = within_cut(key, list(idents), cuts.select("k").scalar(), cuts.select("cut").scalar())
    return rows.withColumn("split", F.when(inside, "eval").otherwise("train"))
