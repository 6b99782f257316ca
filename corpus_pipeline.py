"""The corpus pipeline: stages over `documents`, each written as Parquet and read by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last
return the columns of `docs` and whole rows; the last returns the columns of the encoding.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from turnmill.llm.bpe import encode_documents
from turnmill.llm.common import free_name, remainder, table
from turnmill.llm.decontaminate import scan_documents
from turnmill.llm.language import UNDETERMINED, identify
from turnmill.llm.neardup import near_duplicates
from turnmill.llm.toxicity import toxicity as score_toxicity
from turnmill.session import materialize

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
TOXIC = 0.5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is 0.5 or more go."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    name = free_name(docs, "_toxicity")
    scored = score_toxicity(docs, labels, remainder("doc_id", 5) != 0, into=name)
    return scored.filter(F.col(name) < TOXIC).select(docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no determinable language (no text or no letter) go."""
    name = free_name(docs, "_language")
    found = identify(docs, remainder("doc_id", 4) != 2, into=name)
    return found.filter(F.col(name)["lang_pred"] != UNDETERMINED).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id.

    Of rows with the same id and text one stays. Rows without an id all stay.
    """
    found = near_duplicates(docs).filter("kept and doc_id is not null")
    kept = found.select("doc_id").distinct()
    named = docs.filter("doc_id is not null").join(kept, "doc_id", "left_semi")
    once = named.dropDuplicates(["doc_id", "text"])
    return once.unionByName(docs.filter("doc_id is null")).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a benchmark passage covers a twentieth or more of the words go."""
    name = free_name(docs, "_scan")
    scanned = scan_documents(docs, table(spark, sf_dir, "benchmark"), into=name)
    return scanned.filter(~F.col(name)["contaminated"]).select(docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of the ids and of what they decode to."""
    made = encode_documents(
        docs.select("doc_id", "text"),
        public_tokenizers.path(VOCABULARY),
        public_tokenizers.PATTERN,
    )
    fields = ("n_tokens", "ids_sha256", "decoded_sha256", "ids")
    return made.select("doc_id", *[f"bpe.{field}" for field in fields])


STAGES = [
    ("toxicity", toxicity),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

# SQL expresses neither the classifiers nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
