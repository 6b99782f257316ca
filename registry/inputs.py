"""Inputs of the registered queries, derived from the given tables.

The tables have no chat sources, response runs or training lines, so each is mapped from a whole
table by row: nothing is filtered out or cut to size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnmill.config import Limits, Script, TokenLimits
from turnmill.functions import text as tx
from turnmill.plans.curate import tier_of
from turnmill.plans.profile import conversation_sizes
from turnmill.session import prepare

# The tables hold no Thai; accented Latin letters take its place.
ACCENTED = Script("accented", "\\u00C0-\\u024F")
LIMITS = Limits()
TOKEN_LIMITS = TokenLimits(warn=700, max=1000)
MAIN = "sft"
# Named schemas spare the job that reads a footer for each table.
SCHEMAS = {
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}
TURN_RANGE = 4294967296  # exchange ids are conv_id * 2^32 + turn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = prepare(spark).read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def dataset() -> Column:
    c = F.col("conv_id")
    return F.when(
        c % 5 == 2, F.when(c % 2 == 0, "sovereign_messages").otherwise("sovereign_prompt")
    ).otherwise(MAIN)


def source() -> Column:
    c = F.col("conv_id")
    mixed = F.when(c % 3 == 1, "").when(c % 3 == 2, "ai2-mix")
    return F.when(dataset() == MAIN, F.when(c % 5 <= 1, "autoif").otherwise(mixed))


def tier() -> Column:
    return tier_of(dataset(), source(), MAIN)


def shared_id() -> Column:
    """An id of exchanges (`id`, `conv_id`) that is unique in a tier and occurs in all tiers."""
    c, turn = F.col("conv_id"), F.col("id") % TURN_RANGE
    half = F.when(c % 5 == 1, 1).when(c % 5 == 4, 1).otherwise(0)
    return ((c - c % 5) / 5 * 2 + half).cast("bigint") * TURN_RANGE + turn


def tag(df: DataFrame) -> DataFrame:
    return df.withColumns({"dataset": dataset(), "source": source()})


def conversation_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(spark, sf_dir).select("conv_id").distinct()


def quota_total(spark: SparkSession, sf_dir: str) -> int:
    """A fifth of the conversations, so that quotas grow with the table."""
    return conversation_ids(spark, sf_dir).count() // 5


def exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user turn: it, a system turn just before it and a reply just after it.

    Row-shaped conversations (`id, conv_id, messages`). A turn goes to one user turn at most, and
    a group holds three turns at most, however long the conversation.
    """
    role = F.col("role")
    at = F.col("turn") + F.when(role == "system", 1).when(role == "assistant", -1).otherwise(0)
    message = F.struct("turn", "role", F.col("text").alias("content"))
    return (
        turns(spark, sf_dir)
        .groupBy("conv_id", at.alias("at"))
        .agg(F.sort_array(F.collect_list(message)).alias("_all"))
        .filter(F.exists("_all", lambda x: x["role"] == "user"))
        .select(
            (F.col("conv_id") * TURN_RANGE + F.col("at")).alias("id"),
            "conv_id",
            F.transform(
                "_all",
                lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")),
            ).alias("messages"),
        )
    )


def prompts_and_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user turn: `prompt_id, prompt, adapter, base`.

    The reply after the prompt stands for the adapted model's answer, the reply before it for
    the base model's; either may be missing. One shuffle, three texts per group at most.
    """
    role, turn, text = F.col("role"), F.col("turn"), F.col("text")
    place = lambda at, kind: F.struct(at.alias("at"), F.lit(kind).alias("kind"))
    places = F.when(role == "user", F.array(place(turn, "prompt"))).when(
        role == "assistant", F.array(place(turn - 1, "adapter"), place(turn + 1, "base"))
    )
    pick = lambda kind: F.max(F.when(F.col("p.kind") == kind, text)).alias(kind)
    return (
        turns(spark, sf_dir)
        .select("conv_id", "text", F.explode(places).alias("p"))
        .groupBy("conv_id", "p.at")
        .agg(pick("prompt"), pick("adapter"), pick("base"))
        .filter("prompt is not null")
        .select(
            (F.col("conv_id") * TURN_RANGE + F.col("at")).alias("prompt_id"),
            "prompt",
            "adapter",
            "base",
        )
    )


def responses(pairs: DataFrame, variant: str) -> DataFrame:
    return _timed(
        pairs.filter(F.col(variant).isNotNull()).select(
            "prompt_id",
            F.lit(variant).alias("variant"),
            "prompt",
            F.col(variant).alias("response"),
        )
    )


def all_responses(pairs: DataFrame) -> DataFrame:
    """Both variants from one pass over the pairs."""
    answer = lambda v: F.struct(F.lit(v).alias("variant"), F.col(v).alias("response"))
    answers = F.explode(F.array(answer("base"), answer("adapter"))).alias("a")
    return _timed(
        pairs.select("prompt_id", answers, "prompt")
        .select("prompt_id", "a.variant", "prompt", "a.response")
        .filter("response is not null")
    )


def _timed(answers: DataFrame) -> DataFrame:
    return answers.withColumn("seconds", F.length("response") / F.lit(100.0))


def token_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`corpus, line_no, n_tokens`: a line per conversation, numbered by its id."""
    sizes = conversation_sizes(turns(spark, sf_dir), ACCENTED)
    return sizes.select(
        F.when(F.col("conv_id") % 5 == 0, "eval.jsonl").otherwise("train.jsonl").alias("corpus"),
        F.col("conv_id").alias("line_no"),
        tx.tokens_from_counts(F.col("n_chars"), F.col("n_script"), ACCENTED).alias("n_tokens"),
    )


def _quoted(text: Column) -> Column:
    """`text` as a JSON string."""
    written = F.to_json(F.struct(text.alias("t")))
    return F.substring(written, F.lit(6), F.length(written) - 6)


def _fill(template: str) -> Column:
    """A JSON template with `Q` for the document text and `R` for a short reply."""
    parts, plain = [], ""
    for letter in template:
        if letter in "QR":
            parts += [F.lit(plain), F.col("q" if letter == "Q" else "r")]
            plain = ""
        else:
            plain += letter
    return F.concat(*parts, F.lit(plain))


_U, _A, _S = (f'{{"role":"{r}","content":%s}}' for r in ("user", "assistant", "system"))
_BLANK = '"  "'
CHAT_SHAPES = [
    f"[{_U % 'Q'},{_A % 'R'}]",
    f"[{_S % 'R'},{_U % 'Q'},{_A % 'R'}]",
    f"[{_S % 'Q'},{_S % 'R'},{_U % 'Q'},{_A % 'R'}]",
    f"[{_U % 'Q'},{_S % 'R'},{_A % 'R'}]",
    f"[{_S % _BLANK},{_U % 'Q'},{_A % 'R'}]",
    f'[{_U % "Q"},{{"role":"assistant","content":"","tool_calls":[1]}}]',
    f'[{_U % "Q"},{{"role":"assistant","content":R,"tool_calls":[1]}}]',
    f'[{_U % "Q"},{{"role":"tool","content":R}},{_A % "R"}]',
    f"[{_U % 'Q'},{_A % 'R'},{_U % 'Q'}]",
    "[Q,Q]",
    f"[{_U % 'Q'},Q,{_A % 'R'}]",
    _U % "Q",
    f"[{_U % '5'},{_U % 'Q'},{_A % 'R'}]",
    f'[{_U % "Q"},{{"role":"assistant","content":null,"tool_calls":[]}},{_A % "R"}]',
    f'[{{"content":Q}},{_U % "Q"},{_A % "R"}]',
    None,  # the text itself
]
LINE_SHAPES = [
    f"[{_U % 'Q'},{_A % 'R'}]",
    "   ",
    None,
    _U % "Q",
    f"[{_U % 'Q'}]",
    "[Q,Q]",
    f'[{{"role":"user"}},{_A % "R"}]',
    f"[{_S % 'R'},{_U % 'Q'}]",
    f"[{_U % 'Q'},{_A % _BLANK}]",
    f"[{_A % 'R'},{_U % 'Q'}]",
    f"[{_U % 'Q'},{_A % 'R'},{_U % 'Q'}]",
    f"[{_U % 'Q'},{_U % 'Q'},{_A % 'R'}]",
]


# How many lists stand around a line's value, by document.
LEVELS = [0, 1, 3, 499, 500, 501, 2000, 20_000]


def nested_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`corpus, line_no, line`: every document's whole text inside nested lists, or, for a ninth of the documents, after
    a text of 2,000 brackets in one list."""
    number = F.col("doc_id") % (len(LEVELS) + 1)
    quoted = _quoted(F.col("text"))
    line = F.concat(F.lit('["' + "[{" * 1000 + '",'), quoted, F.lit("]"))
    for place, levels in enumerate(LEVELS):
        around = F.concat(F.lit("[" * levels), quoted, F.lit("]" * levels))
        line = F.when(number == place, around).otherwise(line)
    return table(spark, sf_dir, "documents").select(
        F.concat("lang", F.lit(".jsonl")).alias("corpus"), F.col("doc_id").alias("line_no"), line.alias("line")
    )


def _shaped(spark: SparkSession, sf_dir: str, shapes: list[str | None]) -> DataFrame:
    """Every document's whole text inside one of the JSON shapes: `doc_id, lang, json`."""
    documents = table(spark, sf_dir, "documents").withColumns(
        {
            "q": _quoted(F.col("text")),
            "r": _quoted(F.concat(F.lit("Re: "), F.col("source"))),
        }
    )
    shape = F.col("doc_id") % len(shapes)
    chosen = F.when(F.lit(False), F.lit(""))
    for number, template in enumerate(shapes):
        filled = F.col("text") if template is None else _fill(template)
        chosen = chosen.when(shape == number, filled)
    return documents.select("doc_id", "lang", chosen.alias("json"))


def chat_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shaped(spark, sf_dir, CHAT_SHAPES)


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`corpus, line_no, line`: a training line per document, most with something wrong."""
    return _shaped(spark, sf_dir, LINE_SHAPES).select(
        F.concat("lang", F.lit(".jsonl")).alias("corpus"),
        (F.col("doc_id") + 1).alias("line_no"),
        F.col("json").alias("line"),
    )
