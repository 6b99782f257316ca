"""Column expressions over one conversation held in a row.

Two shapes of input end in the same list of *inspected* elements:

* typed `array<struct<role, content>>` columns, through `inspect_typed`;
* JSON text, through `parse_json` and `inspect_json`, where every element may be anything.

An inspected element is `struct<pos, is_object, has_role, has_content, role, role_text,
content, spoken, tool_calls>`; `content` is NULL unless it is text, and `spoken` says that it is
more than whitespace.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from turnmill.functions import text as tx
from turnmill.functions.nesting import MAX_DEPTH, PARSER_DEPTH, nesting_fault

MESSAGES_TYPE = "array<struct<role:string,content:string>>"


# No single quotes, as JSON has it; texts and numbers as long as can be read. What is nested deeper
# than `PARSER_DEPTH` never gets to the parser, which sees one list more (`parse_json`).
JSON_OPTIONS = {
    "allowSingleQuotes": "false",
    "maxStringLen": str(2**31 - 1),
    "maxNumLen": str(2**31 - 1),
    "maxNestingDepth": str(PARSER_DEPTH + 1),
}
# What a VARIANT value can hold; a larger document is not parsed.
MAX_DOCUMENT_BYTES = 128 * 1024 * 1024


def parse_messages(raw: Column) -> Column:
    """`parse_json` for documents whose values are looked into; NULL too for those nested deeper
    than `MAX_DEPTH`, which `nesting.is_too_deep` tells apart."""
    return parse_json(raw, MAX_DEPTH)


def parse_json(raw: Column, most: int = PARSER_DEPTH) -> Column:
    """The document as VARIANT; NULL where the whole text is not one JSON document, or is nested in
    more than `most` levels.

    The parser stops after the first value, so the text is put in a list with its own hash
    behind it: unless exactly these two come back, the text was something else.
    """
    mark = F.xxhash64(raw)
    safe = F.when(nesting_fault(raw, most).isNull(), raw)
    listed = F.from_json(
        F.concat(F.lit("["), safe, F.lit(","), mark.cast("string"), F.lit("]")),
        "variant",
        JSON_OPTIONS,
    )
    at = lambda d, i, kind: F.try_variant_get(d, f"$[{i}]", kind)
    whole = lambda d: (at(d, 1, "bigint") == mark) & at(d, 2, "variant").isNull()
    # The lambda binds the parsed list, which would otherwise be parsed for each use of it.
    return F.transform(F.array(listed), lambda d: F.when(whole(d), at(d, 0, "variant")))[0]


def elements(document: Column) -> Column:
    """The elements of a JSON list; NULL for anything else."""
    return F.try_variant_get(document, "$", "array<variant>")


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_truthy(value: Column) -> Column:
    """False for absent, null, false, zero and empty values."""
    written = F.to_json(value)
    numeric = _kind(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    zero = numeric & (F.try_variant_get(value, "$", "double") == 0)
    falsy = written.isin("null", "false", '""', "[]", "{}") | F.coalesce(zero, F.lit(False))
    return F.coalesce(~falsy, F.lit(False))


def _inspected(pos, is_object, has_role, has_content, role, role_text, content, tool_calls):
    return F.struct(
        pos.alias("pos"),
        is_object.alias("is_object"),
        has_role.alias("has_role"),
        has_content.alias("has_content"),
        role.alias("role"),
        role_text.alias("role_text"),
        content.alias("content"),
        tx.is_spoken(content).alias("spoken"),
        tool_calls.alias("tool_calls"),
    )


def inspect_json(items: Column) -> Column:
    """Two passes, so that each field is looked up once per message."""

    def fields(x: Column, i: Column) -> Column:
        field = lambda name: F.try_variant_get(x, f"$.{name}", "variant").alias(name)
        return F.struct(
            i.alias("pos"),
            _kind(x).startswith("OBJECT").alias("is_object"),
            field("role"),
            field("content"),
            field("tool_calls"),
        )

    def texts(x: Column) -> Column:
        text = lambda value: F.try_variant_get(value, "$", "string")
        return F.struct(
            x["pos"].alias("pos"),
            x["is_object"].alias("is_object"),
            x["role"].alias("role"),
            x["content"].isNotNull().alias("has_content"),
            F.when(_kind(x["content"]) == "STRING", text(x["content"])).alias("content"),
            text(x["role"]).alias("role_text"),
            is_truthy(x["tool_calls"]).alias("tool_calls"),
        )

    def finish(x: Column) -> Column:
        return _inspected(
            x["pos"],
            x["is_object"],
            x["role"].isNotNull(),
            x["has_content"],
            F.when(_kind(x["role"]) == "STRING", x["role_text"]),
            x["role_text"],
            x["content"],
            x["tool_calls"],
        )

    return F.transform(F.transform(F.transform(items, fields), texts), finish)


def inspect_typed(messages: Column) -> Column:
    def one(x: Column, i: Column) -> Column:
        there = x.isNotNull()
        role, content = x["role"], x["content"]
        return _inspected(i, there, there, there, role, role, content, F.lit(False))

    return F.transform(messages, one)


def _is(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def repeats_role(messages: Column) -> Column:
    """True where two neighbours have the same role."""
    return first_repeat(messages) >= 0


def first_repeat(messages: Column) -> Column:
    """Index of the first message whose follower has the same role; -1 if there is none."""
    n = F.size(messages)
    left = F.slice(messages, F.lit(1), F.greatest(n - 1, F.lit(0)))
    right = F.slice(messages, F.lit(2), F.greatest(n - 1, F.lit(0)))
    same = F.zip_with(left, right, lambda a, b: a["role"].eqNullSafe(b["role"]))
    return F.coalesce(F.array_position(same, True), F.lit(0)).cast("int") - 1


def unusable(inspected: Column) -> Column:
    """True where an element is no message, or an assistant only calls tools."""
    return F.exists(
        inspected,
        lambda x: ~_is(x["is_object"])
        | (~x["spoken"] & _is(x["role"] == "assistant") & _is(x["tool_calls"])),
    )


def kept_turns(inspected: Column) -> Column:
    return F.filter(inspected, lambda x: x["spoken"] & _is(x["role"].isin("user", "assistant")))


def opening_system(inspected: Column, kept: Column) -> Column:
    """The last spoken system text ahead of the first kept turn."""
    start = F.try_element_at(kept, F.lit(1))["pos"]
    ahead = F.filter(
        inspected, lambda x: x["spoken"] & _is(x["role"] == "system") & _is(x["pos"] < start)
    )
    return F.try_element_at(ahead, F.lit(-1))["content"]


def merge_opening(kept: Column, system: Column) -> Column:
    """Kept turns as plain messages, the system text put in front of the first one."""
    start = F.try_element_at(kept, F.lit(1))["pos"]
    return F.transform(
        kept,
        lambda x: F.struct(
            x["role"].alias("role"),
            F.when(
                system.isNotNull() & (x["pos"] == start),
                F.concat(system, F.lit("\n\n"), x["content"]),
            )
            .otherwise(x["content"])
            .alias("content"),
        ),
    )


def is_dialogue(messages: Column) -> Column:
    """At least two messages, user first, assistant last, roles alternating."""
    return _is(
        (F.size(messages) >= 2)
        & (F.try_element_at(messages, F.lit(1))["role"] == "user")
        & (F.try_element_at(messages, F.lit(-1))["role"] == "assistant")
        & ~repeats_role(messages)
    )


def normalize(df, inspected: str, into: str = "messages"):
    """Add `into`: the normalised conversation, or NULL where the row cannot be one.

    The steps are separate columns, so that Catalyst evaluates each array once per row.
    """
    step = df.withColumn("_kept", kept_turns(F.col(inspected)))
    step = step.withColumn("_system", opening_system(F.col(inspected), F.col("_kept")))
    step = step.withColumn("_merged", merge_opening(F.col("_kept"), F.col("_system")))
    usable = F.col(inspected).isNotNull() & ~_is(unusable(F.col(inspected)))
    return step.withColumn(
        into, F.when(usable & is_dialogue(F.col("_merged")), F.col("_merged"))
    ).drop("_kept", "_system", "_merged")


def joined_text(messages: Column) -> Column:
    """Texts of the messages with one space between."""
    return F.array_join(F.transform(messages, lambda x: x["content"]), " ")


def conversation_text(document: Column, raw: Column | None = None, decode: bool = True) -> Column:
    """Text of an unchecked conversation.

    Strings in the list count as text, an object without `content` adds an empty part, and any
    other value is passed over. With `decode`, JSON that is no list gives "" and text that is no
    JSON stands for itself; without it `raw` is returned untouched.
    """
    if not decode:
        return raw
    items = elements(document)

    def part(x: Column) -> Column:
        content = F.try_variant_get(x, "$.content", "variant")
        return (
            F.when(_kind(x) == "STRING", F.try_variant_get(x, "$", "string"))
            .when(
                _kind(x).startswith("OBJECT"),
                F.when(content.isNull(), F.lit("")).when(
                    _kind(content) == "STRING", F.try_variant_get(x, "$.content", "string")
                ),
            )
        )

    joined = F.array_join(F.filter(F.transform(items, part), lambda p: p.isNotNull()), " ")
    # `joined` is NULL unless the document is a list.
    text = F.coalesce(joined, F.when(document.isNotNull(), F.lit("")))
    return text if raw is None else F.coalesce(text, raw, F.lit(""))


def first_text_of(messages: Column, role: str) -> Column:
    found = F.filter(messages, lambda x: x["role"] == role)
    return F.coalesce(F.try_element_at(found, F.lit(1))["content"], F.lit(""))


def last_text(messages: Column) -> Column:
    return F.try_element_at(messages, F.lit(-1))["content"]


def starts_with_role(messages: Column, role: str) -> Column:
    return F.try_element_at(messages, F.lit(1))["role"].eqNullSafe(F.lit(role))


def written_preview(value: Column, n: int) -> Column:
    """First `n` characters of a VARIANT, whatever its type."""
    text = F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value))
    return F.substring(text, 1, n)


def has_short_message(messages: Column, min_chars: int) -> Column:
    return F.exists(messages, lambda x: F.length(tx.strip(x["content"])) < min_chars)


def as_json_line(messages: Column) -> Column:
    return F.to_json(messages)


def first_present(messages: Column, prompt: Column) -> Column:
    """`messages` unless it is missing or empty, else `prompt`."""
    return F.when(F.size(messages) > 0, messages).otherwise(F.coalesce(prompt, F.array()))
