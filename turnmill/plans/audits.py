"""Audits of a training corpus: line format, token budget, and the gates both end in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnmill.config import THAI, Script, TokenLimits
from turnmill.functions import messages as ms, text as tx
from turnmill.functions.line_audit import audit_line
from turnmill.functions.nesting import TOO_DEEP, is_too_deep
from turnmill.operators.order import first_per_group, ranked_values
from turnmill.session import materialize
from turnmill.sources.jsonl import corpus_of, is_blank, read_ordered, with_line_numbers
from turnmill.sources.rewrite import replace_lines

ERRORS_SHOWN = 10
OVER_MAX_SHOWN = 20
OVER_WARN_SHOWN = 10


# Line format


def _audit_once(lines: DataFrame, script: Script) -> DataFrame:
    """Audit every line and keep the narrow result in the shared folder.

    All reports read that table. Without it, a report's filter on `code` would be pushed below
    the audit and the JSON of each line parsed several times over. A blank line has no code.
    """
    audited = audit_line(lines, "line", script)
    code = F.when(~is_blank(F.col("line")), F.col("code"))
    return materialize(audited.withColumn("code", code).drop("line"), "audit")


def audit_numbered(lines: DataFrame, script: Script = THAI) -> DataFrame:
    """Audit a table `corpus, line_no, line`: one narrow row per line that is not blank."""
    return _audit_once(lines, script).filter("code is not null")


def audit_read(lines: DataFrame, script: Script = THAI) -> DataFrame:
    """Audit lines from `sources.jsonl.read_lines`, numbering them on the way.

    Numbers are worked out on the narrow result, where blank lines still take theirs.
    """
    return with_line_numbers(_audit_once(lines, script)).filter("code is not null")


def _for_every(report: DataFrame, corpora: DataFrame | None, counts: list[str]) -> DataFrame:
    """`report` with a row for each of `corpora`; where there was none, `counts` are 0."""
    if corpora is None:
        return report
    return corpora.join(report, "corpus", "left").fillna(0, counts)


def audit_summary(audited: DataFrame, corpora: DataFrame | None = None) -> DataFrame:
    """Per corpus: valid lines, errors, script counts and shares, mean turns (NULL if none).

    With `corpora` (see `sources.jsonl.corpora`) a file without lines has a row too.
    """
    valid = F.col("code") == "valid"
    n_valid, n_script = F.count_if(valid), F.count_if(valid & F.col("has_script"))
    report = (
        audited.groupBy("corpus")
        .agg(
            n_valid.alias("n_valid"),
            F.count_if(~valid).alias("n_errors"),
            n_script.alias("n_script"),
            (n_valid - n_script).alias("n_other"),
            tx.percent(n_script, n_valid).alias("pct_script"),
            tx.percent(n_valid - n_script, n_valid).alias("pct_other"),
            F.avg(F.when(valid, F.col("n_messages"))).alias("mean_turns"),
        )
    )
    counts = ["n_valid", "n_errors", "n_script", "n_other"]
    return _for_every(report, corpora, counts).orderBy("corpus")


def first_errors(audited: DataFrame, n: int = ERRORS_SHOWN) -> DataFrame:
    """The first `n` faulty lines of each corpus, in line order."""
    faulty = audited.filter("code <> 'valid'").select(
        "corpus", "line_no", "code", "msg_index", "detail"
    )
    return first_per_group(faulty, ["corpus"], ["line_no"], n)


def format_gate(audited: DataFrame) -> DataFrame:
    """One row: does every line pass?"""
    return audited.agg(
        F.count_if(F.col("code") != "valid").alias("n_errors"),
        (F.count_if(F.col("code") != "valid") == 0).alias("passed"),
    )


# Token budget


def estimated_tokens(text: Column, script: Script = THAI) -> Column:
    """The built-in counter."""
    return tx.estimate_tokens(text, script)


def counter_udf(load: Callable[[], Callable[[str], int]]):
    """A token counter of the caller's as a vectorised function over a text column.

    `load` runs once per task and returns the counting function, so a model file is
    opened once for many batches.
    """

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = load()
        for texts in batches:
            yield texts.map(counter, na_action="ignore").astype("Int64")

    return count


def message_counter_udf(load: Callable[[], Callable[[list[tuple[str, str]]], int]]):
    """A counter of whole conversations as a vectorised function over `array<struct<role, content>>`.

    `load` runs once per task and returns a function from (role, content) pairs to a number, such as
    the tokens of the text that a chat template renders; roles and contents that are no text are None.
    """

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = load()
        one = lambda chat: None if chat is None else counter([(m["role"], m["content"]) for m in chat])
        for chats in batches:
            yield pd.Series([one(chat) for chat in chats], dtype="Int64")

    return count


def with_overhead(
    n_tokens: Column, messages: Column, per_message: int = 0, system_prompt: int = 0
) -> Column:
    """Add a chat template's tokens; its system prompt counts unless the chat brings one."""
    added = F.when(ms.starts_with_role(messages, "system"), 0).otherwise(system_prompt)
    return n_tokens + F.size(messages) * per_message + added


Template = Callable[[Column, Column], Column]


def _refuse(line: Column) -> Column:
    """Stops the job for a line that has no document."""
    fault = F.when(is_too_deep(line), f"{TOO_DEEP}: ").otherwise("not JSON: ")
    return F.raise_error(F.concat(fault, tx.preview(line, 200)))


def count_lines(
    lines: DataFrame, counter: Callable[[Column], Column], template: Template | None = None
) -> DataFrame:
    """Add `n_tokens` of the text in each JSON line; NULL for a blank one.

    `counter` counts the joined text. `template` makes the final count of that and the line's
    messages, as `with_overhead` does. A line that is no JSON, or nested too deep, stops the job
    with that outcome, as the format audit should have run before.
    """
    parsed = lines.withColumn("_document", ms.parse_messages(tx.strip(F.col("line"))))
    stop = _refuse(F.col("line"))
    text = F.when(F.col("_document").isNull(), stop.cast("string")).otherwise(
        ms.conversation_text(F.col("_document"))
    )
    text = F.when(~is_blank(F.col("line")), text)
    counted = parsed.withColumn("_text", text).withColumn("n_tokens", counter(F.col("_text")))
    if template:
        messages = ms.inspect_json(ms.elements(F.col("_document")))
        counted = counted.withColumn("_messages", messages).withColumn(
            "n_tokens", template(F.col("n_tokens"), F.col("_messages"))
        )
    return counted.drop("_document", "_text", "_messages")


def count_rendered(lines: DataFrame, counter: Callable[[Column], Column]) -> DataFrame:
    """Add `n_tokens` of each JSON line, counted over its messages as a whole (`message_counter_udf`).

    NULL for a blank line; one that is no JSON list stops the job.
    """
    parsed = lines.withColumn("_read", ms.inspect_json(ms.elements(ms.parse_messages(tx.strip(F.col("line"))))))
    spoken = ~is_blank(F.col("line"))
    refused = spoken & F.col("_read").isNull()
    read = F.when(refused, _refuse(F.col("line"))).otherwise(F.col("_read"))
    messages = F.transform(read, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    counted = parsed.withColumn("_messages", F.when(spoken, messages))
    return counted.withColumn("n_tokens", counter(F.col("_messages"))).drop("_read", "_messages")


def count_read(
    lines: DataFrame, counter: Callable[[Column], Column], template: Template | None = None
) -> DataFrame:
    """`corpus, line_no, n_tokens` of lines from `sources.jsonl.read_lines`.

    Counted once and stored; every report below reads the narrow result.
    """
    stored = materialize(count_lines(lines, counter, template).drop("line"), "tokens")
    return with_line_numbers(stored).filter("n_tokens is not null")


def filter_files(
    spark: SparkSession,
    path: str,
    counter: Callable[[Column], Column],
    limits: TokenLimits = TokenLimits(),
    template: Template | None = None,
    corpus: str | None = None,
) -> DataFrame:
    """Take lines over the limit, and blank ones, out of the files in `path`, in place: a table
    `corpus, n_removed` of the lines over it, with a row for every corpus.

    One pass: every line is read, counted and written by the same task. Files, folders and the order of
    lines stay, and a broken off run leaves the old version or the new one (`sources.rewrite`).
    `corpus` may name a partition column, as in `read_lines`.
    """
    counted = count_lines(read_ordered(spark, path), counter, template).filter("n_tokens is not null")
    fits = F.col("n_tokens") <= limits.max
    removed = replace_lines(spark, path, counted, fits)
    own = corpus_of(F.col("file"), corpus)
    return removed.groupBy(own.alias("corpus")).agg(F.sum("n_removed").alias("n_removed")).orderBy("corpus")


def filter_corpus(
    spark: SparkSession,
    path: str,
    counter: Callable[[Column], Column],
    limits: TokenLimits = TokenLimits(),
    template: Template | None = None,
) -> int:
    """`filter_files`; returns how many lines were over the limit."""
    removed = filter_files(spark, path, counter, limits, template)
    return removed.agg(F.coalesce(F.sum("n_removed"), F.lit(0)).alias("n")).first()["n"]


def token_distribution(
    counted: DataFrame, limits: TokenLimits = TokenLimits(), corpora: DataFrame | None = None
) -> DataFrame:
    """Per corpus: size, spread and exact order statistics of `n_tokens`, and lines over limits.

    The statistic at share p is the value at zero-based place `int(n * p)`. With `corpora` a
    file without lines has a row of zeros.
    """
    at = lambda p: F.floor(F.col("n") * F.lit(p))
    tokens = F.col("n_tokens")
    report = ranked_values(
        counted,
        ["corpus"],
        "n_tokens",
        {"median": F.floor(F.col("n") / 2), "p90": at(0.90), "p95": at(0.95), "p99": at(0.99)},
        {
            "over_warn": (tokens > limits.warn) & (tokens <= limits.max),
            "over_max": tokens > limits.max,
        },
    )
    figures = [name for name in report.columns if name != "corpus"]
    return _for_every(report, corpora, figures).orderBy("corpus")


def over_limit(counted: DataFrame, limits: TokenLimits = TokenLimits()) -> DataFrame:
    """The first lines over each limit, per corpus in line order."""
    tokens = F.col("n_tokens")
    flagged = counted.select(
        "corpus",
        "line_no",
        "n_tokens",
        F.when(tokens > limits.max, "max").when(tokens > limits.warn, "warn").alias("over"),
    ).filter("over is not null")
    most = max(OVER_MAX_SHOWN, OVER_WARN_SHOWN)
    shown = F.when(F.col("over") == "max", OVER_MAX_SHOWN).otherwise(OVER_WARN_SHOWN)
    return first_per_group(flagged, ["corpus", "over"], ["line_no"], most).filter(
        F.col("place") <= shown
    )


def within_limit(counted: DataFrame, limits: TokenLimits = TokenLimits()) -> DataFrame:
    return counted.filter(F.col("n_tokens") <= limits.max)


def removed_counts(counted: DataFrame, limits: TokenLimits = TokenLimits()) -> DataFrame:
    """What the filter would take from each corpus."""
    fits = F.col("n_tokens") <= limits.max
    return (
        counted.groupBy("corpus")
        .agg(F.count_if(fits).alias("n_kept"), F.count_if(~fits).alias("n_removed"))
        .orderBy("corpus")
    )


def token_gate(counted: DataFrame, limits: TokenLimits = TokenLimits()) -> DataFrame:
    over = F.count_if(F.col("n_tokens") > limits.max)
    return counted.agg(over.alias("n_over"), (over == 0).alias("passed"))


class GateFailed(Exception):
    """A corpus did not pass its audit."""


def require_passed(gate: DataFrame) -> None:
    """Raise unless the one-row gate passed; this is where a job script stops."""
    row = gate.first()
    if not row["passed"]:
        raise GateFailed(", ".join(f"{k}={v}" for k, v in row.asDict().items()))
