"""Profile of raw conversations: sources, sizes, script shares, sample rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnmill.config import (
    PROFILE_ROWS,
    SAMPLE_ROWS,
    SAMPLE_SOURCE_PREFIX,
    TARGET_SOURCE,
    THAI,
    Script,
)
from turnmill.functions import messages as ms, text as tx
from turnmill.functions.nesting import is_too_deep
from turnmill.operators.order import first_idents, first_per_group, keep_first
from turnmill.plans.curate import with_share

PREVIEW_CHARS = 150
PREVIEW_MESSAGES = 4


def conversation_sizes(turns: DataFrame, script: Script = THAI) -> DataFrame:
    """`conv_id, n_messages, n_chars, n_script, has_script` of the unchecked text, texts joined
    by one space. Sums only: no conversation is gathered."""
    text = F.col("text")
    has_text = text.isNotNull()
    return (
        turns.groupBy("conv_id")
        .agg(
            F.count(F.lit(1)).alias("n_messages"),
            F.count("text").alias("_parts"),
            F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("_chars"),
            F.coalesce(
                F.sum(F.when(has_text, tx.script_chars(text, script))), F.lit(0)
            ).alias("n_script"),
        )
        .select(
            "conv_id",
            "n_messages",
            (F.col("_chars") + F.greatest(F.col("_parts") - 1, F.lit(0))).alias("n_chars"),
            "n_script",
            (F.col("n_script") > 0).alias("has_script"),
        )
    )


def script_flags(turns: DataFrame, script: Script = THAI) -> DataFrame:
    """`conv_id, has_script`: the test alone, which stops at the first hit in each text."""
    found = F.coalesce(tx.contains_script(F.col("text"), script), F.lit(False))
    return turns.groupBy("conv_id").agg(F.bool_or(found).alias("has_script"))


def opening_text(turns: DataFrame, n: int = PREVIEW_CHARS) -> DataFrame:
    """`conv_id, opening`: the first `n` characters of the joined text.

    Every message adds a character at least (the space), so the first `n` messages hold them.
    """
    parts = turns.filter("text is not null").select(
        "conv_id", "turn", F.substring("text", 1, n).alias("part")
    )
    ordered = F.sort_array(F.collect_list(F.struct("turn", "part")))
    return (
        first_per_group(parts, ["conv_id"], ["turn"], n)
        .groupBy("conv_id")
        .agg(F.transform(ordered, lambda x: x["part"]).alias("parts"))
        .select("conv_id", F.substring(F.array_join("parts", " "), 1, n).alias("opening"))
    )


def source_histogram(tagged: DataFrame) -> DataFrame:
    """Rows and share per source, most common first; NULL is a source of its own."""
    return with_share(tagged.groupBy("source").agg(F.count(F.lit(1)).alias("n"))).orderBy(
        F.desc("n"), F.asc_nulls_first("source")
    )


def source_or_unknown(rows: DataFrame) -> Column:
    """`source`, or `unknown` for a table that has no such column; NULL stays NULL."""
    return F.col("source") if "source" in rows.columns else F.lit("unknown")


def turn_counts(turns: DataFrame) -> DataFrame:
    """`conv_id, n_messages` of conversations stored turn by turn."""
    return turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_messages"))


def measured_rows(rows: DataFrame, script: Script = THAI) -> DataFrame:
    """Add `n_messages, has_script` to conversations stored one per row, typed or as JSON text.

    A text that is no JSON list has no message count, but its script is tested all the same. For
    JSON text `too_deep` says that it is nested too deep to be parsed.
    """
    m = F.col("messages")
    if dict(rows.dtypes)["messages"] != "string":
        found = F.exists(m, lambda x: tx.contains_script(x["content"], script))
        return rows.withColumns(
            {
                "n_messages": F.array_size(m).cast("bigint"),
                "has_script": F.coalesce(found, F.lit(False)),
            }
        )
    parsed = rows.withColumn("_document", ms.parse_messages(m))
    # Profiling looks at JSON text as it is written, before any decoding.
    text = ms.conversation_text(F.col("_document"), m, decode=False)
    return parsed.withColumns(
        {
            "n_messages": F.array_size(ms.elements(F.col("_document"))).cast("bigint"),
            "has_script": tx.contains_script(text, script),
            "too_deep": F.col("_document").isNull() & is_too_deep(m),
        }
    ).drop("_document")


def turn_stats(counted: DataFrame) -> DataFrame:
    """Fewest, most and mean messages of a conversation."""
    return counted.agg(
        F.min("n_messages").alias("min_messages"),
        F.max("n_messages").alias("max_messages"),
        F.avg("n_messages").alias("mean_messages"),
    )


def first_conversations(turns: DataFrame, n: int) -> DataFrame:
    """Turns of the first `n` conversations; the bound on `conv_id` is pushed to the scan."""
    return turns.filter(F.col("conv_id") <= first_idents(turns, "conv_id", n))


def script_share(flagged: DataFrame) -> DataFrame:
    """Share of rows with the script: `n_rows, n_script, pct_script`."""
    return flagged.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("has_script").alias("n_script")
    ).withColumn("pct_script", tx.percent(F.col("n_script"), F.col("n_rows")))


def script_share_by_source(flagged: DataFrame) -> DataFrame:
    """The same per source, largest first."""
    return (
        flagged.groupBy(source_or_unknown(flagged).alias("source"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("has_script").alias("n_script"))
        .withColumn("pct_script", tx.percent(F.col("n_script"), F.col("n_rows")))
        .orderBy(F.desc("n_rows"), F.asc_nulls_first("source"))
    )


def sample_class(source: Column) -> Column:
    """The kinds of source a sample shows one row of; NULL for any other source."""
    source = F.coalesce(source, F.lit(""))
    return (
        F.when(source == TARGET_SOURCE, TARGET_SOURCE)
        .when(source == "", "empty")
        .when(source.startswith(SAMPLE_SOURCE_PREFIX), SAMPLE_SOURCE_PREFIX)
    )


def sample_by_class(tagged: DataFrame, ident: str = "conv_id", n: int = SAMPLE_ROWS) -> DataFrame:
    """The first row of each class among the first `n`: `ident, source, class`."""
    head = tagged.filter(F.col(ident) <= first_idents(tagged, ident, n))
    classed = head.select(ident, "source", sample_class(F.col("source")).alias("class"))
    return keep_first(classed.filter("class is not null"), ["class"], [ident])


def first_of_each(tagged: DataFrame, ident: str = "conv_id") -> DataFrame:
    """The first row of every dataset: `dataset, ident`."""
    return tagged.groupBy("dataset").agg(F.min(ident).alias(ident))


def sample_messages(turns: DataFrame, samples: DataFrame) -> DataFrame:
    """The first messages of sampled conversations, cut to a preview.

    `samples` holds a row per class or dataset, few enough to broadcast.
    """
    shown = turns.join(F.broadcast(samples.select("conv_id")), "conv_id")
    return first_per_group(shown, ["conv_id"], ["turn"], PREVIEW_MESSAGES).select(
        "conv_id", "place", "role", tx.preview(F.col("text"), PREVIEW_CHARS).alias("preview")
    )


def sample_row_messages(samples: DataFrame, ident: str = "id") -> DataFrame:
    """The same for sampled conversations stored one per row."""
    shown = F.posexplode(F.slice("messages", 1, PREVIEW_MESSAGES)).alias("place", "m")
    return samples.select(ident, shown).select(
        ident,
        (F.col("place") + 1).alias("place"),
        "m.role",
        tx.preview(F.col("m.content"), PREVIEW_CHARS).alias("preview"),
    )
