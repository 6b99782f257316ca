"""Registered queries of the operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import functions as F

from turnmill.llm.common import remainder, table
from turnmill.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op10_sharding(spark, sf_dir):
    from turnmill.llm.sharding import shard_by_bytes

    return shard_by_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op6_decontaminate(spark, sf_dir):
    from turnmill.llm.decontaminate import scan_documents

    found = scan_documents(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark"),
    )
    return found.select(
        "doc_id",
        "scan.n_words",
        "scan.n_hit",
        F.size("scan.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "scan.items"), 256).alias("items_sha256"),
        "scan.contaminated",
    )


@query
def op8_byte_bpe(spark, sf_dir):
    import public_tokenizers

    from turnmill.llm.bpe import encode_documents

    made = encode_documents(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        with_ids=False,
    )
    return made.select("doc_id", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")


@query
def op9_toxicity(spark, sf_dir):
    from turnmill.llm.toxicity import toxicity

    held_out = remainder("doc_id", 5) == 0
    scored = toxicity(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "labels").select("doc_id", "toxic"),
        ~held_out,
        into="score",
    )
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op1_language_id(spark, sf_dir):
    from turnmill.llm.language import identify

    held_out = remainder("doc_id", 4) == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, ~held_out)
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        "language.lang_pred",
        "language.score",
        "language.ambiguous",
    )


@query
def op4_quality(spark, sf_dir):
    from turnmill.llm.quality import quality

    held_out = remainder("doc_id", 3) == 1
    scored = quality(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "labels").select("doc_id", "quality"),
        ~held_out,
        into="score",
    )
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op7_lm_score(spark, sf_dir):
    from turnmill.llm.ppm import score_documents

    held_out = remainder("doc_id", 10) == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(docs.withColumn("held_out", held_out), ~held_out)
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@query
def op2_minmax_dedup(spark, sf_dir):
    from turnmill.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_nearest(spark, sf_dir):
    from turnmill.llm.ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@query
def op5_main_text(spark, sf_dir):
    from turnmill.llm.extract import main_text

    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text(pages, into="text").select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars")
    )


@query
def op11_whitening(spark, sf_dir):
    from turnmill.llm.whitening import whiten

    made = whiten(table(spark, sf_dir, "embeddings"))
    return made.withColumn("deviation", F.col("deviation").cast("bigint"))


def _looped():
    """A tenth of the texts, by their identifier's hash, from some word on as repeats of a stretch."""

    @F.pandas_udf("string")
    def looped(idents: pd.Series, texts: pd.Series) -> pd.Series:
        made = []
        for ident, text in zip(idents, texts):
            g, rest = divmod(zlib.crc32(ident.encode()), 10)
            words = text.encode().split() if text and not rest else []
            if words:
                start = g % len(words)
                period = 1 + (len(words) - start) // (3 + g % 8)
                tail = words[start : start + period] * (12 + g % 8)
                text = b" ".join((words[:start] + tail)[: len(words)]).decode()
            made.append(text)
        return pd.Series(made, dtype=object)

    return looped


@query
def op13_periodic_runs(spark, sf_dir):
    from turnmill.llm.runs import word_runs

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = docs.select("doc_id", word_runs(_looped()(ident, F.col("text"))).alias("r"))
    written = F.transform("r.runs", lambda x: F.format_string("%d,%d,%d\n", x["start"], x["length"], x["period"]))
    best = F.col("r.strongest")
    return found.select(
        "doc_id",
        F.size("r.runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("(1000 * r.strongest.length) div r.strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(written, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("r.collapsed"), 256).alias("collapsed_sha256"),
    )


@query
def op12_ngram_join(spark, sf_dir):
    from turnmill.llm.ngram_join import ngram_components

    return ngram_components(table(spark, sf_dir, "documents"))
