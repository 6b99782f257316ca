"""Format audit of one training line: the first thing wrong with it, and where."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnmill.config import Script
from turnmill.functions import messages as ms, text as tx
from turnmill.functions.nesting import TOO_DEEP, is_too_deep

# Names under which a JSON type is reported.
TYPE_NAMES = {
    "OBJECT": "dict",
    "STRING": "str",
    "BIGINT": "int",
    "DECIMAL": "float",
    "DOUBLE": "float",
    "BOOLEAN": "bool",
    "VOID": "NoneType",
}
# End of fixed values.


def _type_name(document: Column) -> Column:
    kind = F.regexp_extract(F.schema_of_variant(document), "^[A-Z]+", 0)
    names = F.create_map(*[F.lit(x) for pair in TYPE_NAMES.items() for x in pair])
    return F.coalesce(names[kind], F.lower(kind))


def _message_fault(x: Column) -> Column:
    role_ok = F.coalesce(x["role"].isin("user", "assistant"), F.lit(False))
    fault = (
        F.when(~x["is_object"], "msg_not_dict")
        .when(~(x["has_role"] & x["has_content"]), "missing_key")
        .when(~role_ok, "bad_role")
        .when(~x["spoken"], "empty_content")
    )
    return F.struct(
        x["pos"].alias("pos"), fault.alias("code"), x["role_text"].alias("role")
    )


def audit_line(df: DataFrame, line: str, script: Script) -> DataFrame:
    """Add `code` (`valid` or the first fault), `msg_index`, `detail`, `n_messages`, `has_script`.

    Faults inside messages are ranked by message first and by check second. `line` must hold
    text other than whitespace; blank lines are no lines (see `sources.jsonl`).
    """
    document = F.col("_document")
    first_fault = F.try_element_at(
        F.filter(
            F.transform(F.col("_inspected"), _message_fault), lambda z: z["code"].isNotNull()
        ),
        F.lit(1),
    )
    n = F.size("_inspected")
    first_role = F.try_element_at("_inspected", F.lit(1))["role"]
    last_role = F.try_element_at("_inspected", F.lit(-1))["role"]
    step = (
        df.withColumn("_document", ms.parse_messages(tx.strip(F.col(line))))
        .withColumn("_inspected", ms.inspect_json(ms.elements(document)))
        .withColumn("_fault", F.when(n >= 2, first_fault))
        .withColumn("_repeat", ms.first_repeat(F.col("_inspected")))
        .withColumn(
            "code",
            F.when(
                document.isNull() & (F.octet_length(line) > ms.MAX_DOCUMENT_BYTES), "too_large"
            )
            .when(document.isNull() & is_too_deep(F.col(line)), TOO_DEEP)
            .when(document.isNull(), "invalid_json")
            .when(F.col("_inspected").isNull(), "not_list")
            .when(n < 2, "too_few")
            .when(F.col("_fault.code").isNotNull(), F.col("_fault.code"))
            .when(first_role != "user", "bad_start")
            .when(last_role != "assistant", "bad_end")
            .when(F.col("_repeat") >= 0, "non_alternating")
            .otherwise("valid"),
        )
    )
    code = F.col("code")
    return (
        step.withColumn(
            "msg_index",
            F.when(code == "non_alternating", F.col("_repeat")).when(
                code == F.col("_fault.code"), F.col("_fault.pos")
            ),
        )
        .withColumn(
            "detail",
            F.when(code == "not_list", _type_name(document))
            .when(code == "too_few", n.cast("string"))
            .when(code == "bad_role", F.col("_fault.role")),
        )
        .withColumn("n_messages", F.when(F.col("_inspected").isNotNull(), n).cast("bigint"))
        .withColumn(
            "has_script",
            F.when(
                code == "valid",
                F.exists("_inspected", lambda x: tx.contains_script(x["content"], script)),
            ),
        )
        .drop("_document", "_inspected", "_fault", "_repeat")
    )
