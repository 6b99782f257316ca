"""Raw conversations in, a balanced, de-duplicated, split corpus and its statistics out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from turnmill.config import OTHER_LANGUAGE_TIER, SEED, THAI, TARGET_SOURCE, Limits, Script
from turnmill.functions import messages as ms, text as tx
from turnmill.functions.nesting import TOO_DEEP, is_too_deep
from turnmill.functions.verdict import ACCEPTED, measures_of, outcome
from turnmill.operators.order import keep_first, small_side, within_cut
from turnmill.operators.quota import apply_quota, exact_split, quota_cuts
from turnmill.operators.turns import assemble, conversation_facts
from turnmill.session import materialize

def tier_of(dataset: Column, source: Column, main_dataset: str) -> Column:
    """Tier of a row. Sources are compared so that NULL and "" count as other sources."""
    return (
        F.when(dataset != main_dataset, "sovereign")
        .when(source == TARGET_SOURCE, "autoif")
        .otherwise(OTHER_LANGUAGE_TIER)
    )


@dataclass(frozen=True)
class Curated:
    """`verdicts`: `ident, tier, outcome, draw_key, selected` of every row a tier looked at.
    `corpus`: what is left of the selected ones: `ident, tier, tier_no, split, messages`."""

    verdicts: DataFrame
    corpus: DataFrame


@dataclass(frozen=True)
class Scanned:
    """`verdicts` as in `Curated`, with `target`, and the tiers' cutoffs."""

    verdicts: DataFrame
    cuts: DataFrame


class RepeatedRow(ValueError):
    """A row key that occurs twice in one tier."""


def scan_verdicts(
    measured: DataFrame,
    quotas: DataFrame,
    script: Script,
    limits: Limits,
    seed: int,
    ident: str,
    places: tuple[str, ...] = (),
) -> Scanned:
    """Judge rows once and mark those in draw order up to the one that fills the tier's quota.

    `measured` has one row per conversation and tier with the measures; tiers without a quota
    are left out. The judged rows are narrow and stored; cutoffs, counts and marks work on them.
    Raises `RepeatedRow` if a tier has a row key twice, since the draw order would not
    tell the rows apart.
    """
    judged = outcome(F.col("rule"), script, limits)
    if TOO_DEEP in measured.columns:
        judged = F.when(F.col(TOO_DEEP), TOO_DEEP).otherwise(judged)
    verdict = (
        measured.join(small_side(quotas), "tier")
        .withColumn("outcome", judged)
        .withColumn("draw_key", tx.draw_key(seed, F.col("tier"), F.col(ident)))
    )
    columns = [ident, "tier", "tier_no", "target", "outcome", "draw_key", *places]
    verdicts = materialize(verdict.select(*columns), "verdicts")
    twice = verdicts.groupBy("tier", ident).count().filter("count > 1").first()
    if twice:
        raise RepeatedRow(f"{ident} {twice[ident]} occurs {twice['count']} times in {twice['tier']}")
    cuts = quota_cuts(verdicts, ident)
    marked = apply_quota(verdicts, cuts, ident).filter("scanned").drop("scanned")
    return Scanned(marked, cuts)


def _before_cut(rows: DataFrame, cuts: DataFrame, seed: int, ident: str) -> DataFrame:
    """Those of `rows` (with `tier`) that come no later than their tier's cutoff.

    The draw key follows from tier and key, so this is decided on the row itself: texts past the
    cutoff are never shuffled. Every selected row passes.
    """
    keyed = rows.withColumn("draw_key", tx.draw_key(seed, F.col("tier"), F.col(ident)))
    return keyed.join(cuts, "tier").filter(within_cut("draw_key", [ident])).drop("cut", "k")


def _finish(
    scanned: Scanned, texts: DataFrame, limits: Limits, seed: int, ident: str
) -> Curated:
    opening = ms.first_text_of(F.col("messages"), "user")
    keyed = texts.withColumn("dedup_key", tx.prefix_key(opening, limits.dedup_chars))
    unique = keep_first(keyed, ["dedup_key"], ["tier_no", "draw_key", ident]).withColumn(
        "split_key", tx.draw_key(seed, "split", F.col(ident))
    )
    unique = materialize(unique, "unique")
    corpus = exact_split(unique, limits.eval_share, "split_key", (ident, "tier"))
    return Curated(
        scanned.verdicts.drop("target"),
        corpus.select(ident, "tier", "tier_no", "split", "messages"),
    )


def _chosen(scanned: Scanned, columns: list[str]) -> DataFrame:
    """The selected rows as a stored table, whose real size decides how the text is joined: a
    quota's few rows are broadcast, more than `autoBroadcastJoinThreshold` are not."""
    return materialize(scanned.verdicts.filter("selected").select(*columns), "chosen")


def _scan_turns(
    turns: DataFrame,
    tier: Column | DataFrame,
    quotas: DataFrame,
    script: Script,
    limits: Limits,
    seed: int,
) -> Scanned:
    facts = conversation_facts(turns, script, limits)
    return scan_verdicts(
        _with_tier(facts, tier), quotas, script, limits, seed, "conv_id", ("system_turn",)
    )


def _with_tier(rows: DataFrame, tier: Column | DataFrame) -> DataFrame:
    if isinstance(tier, DataFrame):
        return rows.join(tier.select("conv_id", "tier"), "conv_id")
    return rows.withColumn("tier", tier)


def turn_verdicts(
    turns: DataFrame,
    tier: Column | DataFrame,
    quotas: DataFrame,
    script: Script = THAI,
    limits: Limits = Limits(),
    seed: int = SEED,
) -> DataFrame:
    """Verdicts on conversations stored turn by turn (`conv_id, turn, role, text`).

    `tier` is an expression over `conv_id`, or a table `conv_id, tier`.
    """
    return _scan_turns(turns, tier, quotas, script, limits, seed).verdicts.drop("target")


def curate_turns(
    turns: DataFrame,
    tier: Column | DataFrame,
    quotas: DataFrame,
    script: Script = THAI,
    limits: Limits = Limits(),
    seed: int = SEED,
) -> Curated:
    """Curate conversations stored turn by turn (see `turn_verdicts`).

    The text is scanned down to narrow facts first, then once more for the selected rows. A tier
    given as an expression lets turns past its cutoff go at that scan, before any text
    is shuffled; with a table of tiers the selected rows are the first thing turns are joined with.
    """
    scanned = _scan_turns(turns, tier, quotas, script, limits, seed)
    chosen = _chosen(scanned, ["conv_id", "tier", "tier_no", "draw_key", "system_turn"])
    part = turns
    if not isinstance(tier, DataFrame):
        near = _before_cut(_with_tier(turns, tier), scanned.cuts, seed, "conv_id")
        part = near.select(turns.columns)
    texts = assemble(part, chosen).drop("system_turn")
    return _finish(scanned, texts, limits, seed, "conv_id")


def curate_rows(
    rows: DataFrame,
    quotas: DataFrame,
    script: Script = THAI,
    limits: Limits = Limits(),
    seed: int = SEED,
    ident: str = "id",
) -> Curated:
    """Curate conversations stored one per row (`ident, tier, messages`).

    A row is known by tier and `ident` together: splits of different tiers may share identifiers.
    Only narrow verdicts are kept of the first pass; the second normalises the selected rows
    again, which is cheaper than storing every text.
    """
    measured = measures_of(normalized_rows(rows), "messages", script, limits).drop("messages")
    scanned = scan_verdicts(measured, quotas, script, limits, seed, ident)
    chosen = _chosen(scanned, [ident, "tier", "tier_no", "draw_key"])
    near = _before_cut(rows, scanned.cuts, seed, ident).drop("draw_key")
    texts = normalized_rows(near.join(chosen, [ident, "tier"])).select(*chosen.columns, "messages")
    return _finish(scanned, texts, limits, seed, ident)


def normalized_rows(rows: DataFrame) -> DataFrame:
    """`rows` with `messages`, a typed array, JSON text or VARIANT, replaced by its normal form, and `too_deep`
    for text that is nested too deep to be parsed."""
    m = F.col("messages")
    kind = dict(rows.dtypes)["messages"]
    if kind in ("string", "variant"):
        inspected = ms.inspect_json(ms.elements(ms.parse_messages(m) if kind == "string" else m))
    else:
        inspected = ms.inspect_typed(m)
    deep = F.col("_inspected").isNull() & is_too_deep(m) if kind == "string" else F.lit(False)
    step = rows.withColumn("_inspected", inspected).withColumn("too_deep", deep)
    return ms.normalize(step, "_inspected").drop("_inspected")


def reason_counts(verdicts: DataFrame) -> DataFrame:
    """Rows per tier and outcome among the rows a tier had to look at."""
    return (
        verdicts.groupBy("tier", "tier_no", "outcome")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("tier_no", "outcome")
        .select("tier", "outcome", "n")
    )


def quota_counts(verdicts: DataFrame, quotas: DataFrame) -> DataFrame:
    """Collected rows next to the target of every tier, empty tiers included."""
    collected = verdicts.groupBy("tier").agg(F.count_if("selected").alias("collected"))
    return (
        quotas.join(collected, "tier", "left")
        .orderBy("tier_no")
        .select("tier", "target", F.coalesce("collected", F.lit(0)).alias("collected"))
    )


def dedup_counts(made: Curated) -> DataFrame:
    """Rows ahead of de-duplication and after it. Neither count touches a text."""
    before = made.verdicts.agg(F.count_if("selected").alias("n_before"))
    after = made.corpus.agg(F.count(F.lit(1)).alias("n_after"))
    return before.withColumn("n_after", after.scalar())


def key_counts(keyed: DataFrame) -> DataFrame:
    """The same for any rows with a `dedup_key`."""
    return keyed.agg(
        F.count(F.lit(1)).alias("n_before"), F.countDistinct("dedup_key").alias("n_after")
    )


def split_counts(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy("split").agg(F.count(F.lit(1)).alias("n")).orderBy("split")


def tier_mix(corpus: DataFrame) -> DataFrame:
    """Rows and share of each tier, largest first."""
    return with_share(corpus.groupBy("tier").agg(F.count(F.lit(1)).alias("n"))).orderBy(
        F.desc("n"), "tier"
    )


def language_mix(corpus: DataFrame) -> DataFrame:
    """Rows and share by language as the tier claims it."""
    language = F.when(F.col("tier") == OTHER_LANGUAGE_TIER, "other").otherwise("target")
    counted = corpus.groupBy(language.alias("language")).agg(F.count(F.lit(1)).alias("n"))
    return with_share(counted).orderBy("language")


def with_share(counted: DataFrame) -> DataFrame:
    """Add `pct`, the share of `n` in the total. `counted` has one row per group, and only
    those rows meet in the total's window."""
    return counted.withColumn(
        "pct", tx.percent(F.col("n"), F.sum("n").over(Window.partitionBy()))
    )
