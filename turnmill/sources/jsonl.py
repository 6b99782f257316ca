"""JSONL corpora: one JSON list of messages per line."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from turnmill.functions import messages as ms, text as tx
from turnmill.functions.nesting import TOO_DEEP, is_too_deep
from turnmill.sources import rewrite
from turnmill.sources.rewrite import hadoop


SPLITS = ("train", "eval")


class EmptyCorpus(Exception):
    """No file to work on."""


def read_lines(spark: SparkSession, path: str, corpus: str | None = None) -> DataFrame:
    """Lines of every file `path` matches: `corpus, file, block, seq, line`, blank ones included.

    `corpus` names what is numbered and reported as one; by default each file, at any depth, is its own, by its
    path below the folder that is read (what a glob leaves fixed), and a
    partition column such as `split` can be given instead. Both are text as the names have it. `block` is where the scan's split
    starts in the file and `seq` grows by one per line inside it, which is all that line numbers
    need (`with_line_numbers`).
    """
    rewrite.finish(spark, path)
    try:
        raw = rewrite.text_files(spark, path)
    except Exception as error:
        if getattr(error, "getCondition", lambda: "")() == "PATH_NOT_FOUND":
            raise EmptyCorpus(path) from error
        raise
    return raw.select(
        _named(spark, path, F.col("_metadata.file_path"), corpus).alias("corpus"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"),
    )


def corpus_of(own: Column, corpus: str | None = None) -> Column:
    """The corpus a file belongs to, by its place below the folder that is read (see `read_lines`)."""
    if corpus is None:
        # What a rewrite made of a large file: a folder under the file's name.
        return F.regexp_replace(own, r"^((?:.*?/)??[^/]+\.(?:jsonl|ndjson|json|txt))/.*$", "$1")
    # Values of partition columns are written with some characters as %XX.
    return rewrite.decoded(F.regexp_extract(own, f"(?:^|/){re.escape(corpus)}=([^/]*)/", 1))


def _named(spark: SparkSession, path: str, file: Column, corpus: str | None) -> Column:
    return corpus_of(rewrite.below(spark, path, file), corpus)


def corpora(spark: SparkSession, path: str, corpus: str | None = None) -> DataFrame:
    """`corpus` of every file `path` matches, files without a line included.

    From the listing that every read makes; with `corpus` the value of that partition column.
    """
    rewrite.finish(spark, path)
    files = [(name,) for name in rewrite.text_files(spark, path).inputFiles()]
    own = _named(spark, path, F.col("file"), corpus)
    return spark.createDataFrame(files, "file string").select(own.alias("corpus")).distinct()


def is_blank(line: Column) -> Column:
    return ~tx.is_spoken(line)


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """Replace `file, block, seq` by `line_no`, counted from 1 in each corpus.

    `lines` must be a materialised table holding every line that was read, since blank lines use
    up numbers and `seq` belongs to one scan. Lines per block are counted and summed
    up in file order (one row per block); a line's number is then that sum plus its place
    in the block, so lines themselves are never sorted.
    """
    earlier = (
        Window.partitionBy("corpus")
        .orderBy("file", "block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = (
        lines.groupBy("corpus", "file", "block")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("seq").alias("_from"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    return (
        lines.join(blocks, ["corpus", "file", "block"])
        .withColumn("line_no", F.col("_before") + F.col("seq") - F.col("_from") + 1)
        .drop("file", "block", "seq", "_before", "_from")
    )


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """A prompt file: `messages` per line, blank lines skipped. A line that is no JSON list, or is
    nested too deep, stops the job."""
    value = F.col("value")
    items = ms.inspect_json(ms.elements(ms.parse_messages(tx.strip(value))))
    fault = F.when(is_too_deep(value), f"{TOO_DEEP}, not a JSON list: ").otherwise("not a JSON list: ")
    stop = F.raise_error(F.concat(fault, tx.preview(value, 200)))
    parsed = (
        spark.read.text(path)
        .filter(~is_blank(value))
        .withColumn("_read", items)
        .withColumn("_items", F.when(F.col("_read").isNull(), stop).otherwise(F.col("_read")))
    )
    return parsed.select(
        F.transform(
            "_items", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))
        ).alias("messages")
    )


def write_jsonl(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Write only `messages`, a JSON list per line; `by` columns become folders."""
    by = by or []
    lines = df.select(*by, ms.as_json_line(F.col("messages")).alias("value"))
    writer = lines.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).text(path)


def write_corpora(lines: DataFrame, root: str, names: Sequence[str] = ()) -> None:
    """Write the `line`s of a table `corpus, line` as a folder of text files per corpus, under the
    corpus's name in `root`, which `read_lines` takes for one corpus. A name in `names` that has no line is
    there as an empty file."""
    spark, parts = lines.sparkSession, f"{root}/_parts-{uuid.uuid4().hex}"
    lines.select("corpus", F.col("line").alias("value")).write.partitionBy("corpus").text(parts)
    home, system = hadoop(spark, root)
    at = spark._jvm.org.apache.hadoop.fs.Path
    for made in system.listStatus(hadoop(spark, parts)[0]):
        kind, _, name = made.getPath().getName().partition("=")
        if kind == "corpus":
            target = at(home, unquote(name))
            system.mkdirs(target.getParent())
            system.delete(target, True)
            if not system.rename(made.getPath(), target):
                raise OSError(f"{made.getPath()} could not be renamed to {target}")
    for name in names:
        if not system.exists(at(home, name)):
            system.create(at(home, name)).close()
    system.delete(hadoop(spark, parts)[0], True)


def write_run(df: DataFrame, root: str, run_id: str) -> None:
    """Write a curated corpus as `root/run_id=.../split=...`, replacing that run only. A split
    without rows is there as an empty file."""
    spark, path = df.sparkSession, f"{root}/run_id={run_id}"
    write_jsonl(df, path, ["split"])
    for split in SPLITS:
        folder, system = hadoop(spark, f"{path}/split={split}")
        if not system.exists(folder):
            spark.createDataFrame([], "value string").coalesce(1).write.text(f"{path}/split={split}")


def read_run(spark: SparkSession, root: str, run_id: str, split: str | None = None) -> DataFrame:
    """Lines of one run; raises `EmptyCorpus` if the run or the split is not there."""
    path = f"{root}/run_id={run_id}"
    if split:
        folder, system = hadoop(spark, f"{path}/split={split}")
        if not system.exists(folder):
            raise EmptyCorpus(f"{path}/split={split}")
    lines = read_lines(spark, path, corpus="split")
    return lines.filter(F.col("corpus") == split) if split else lines


def write_records(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """One JSON object per row, NULL fields included."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", False)
    (writer.partitionBy(*by) if by else writer).json(path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """`line` of all files in `path` and its place (`rewrite.PLACE`)."""
    rewrite.finish(spark, path)
    return rewrite.text_files(spark, path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
    )


def rewrite_lines(spark: SparkSession, path: str, keep: DataFrame) -> int:
    """Replace the lines in `path` by `keep`, a selection of the rows of `read_ordered`. Returns how
    many lines there are now. Files, their names and the order of lines stay (`sources.rewrite`)."""
    rewrite.replace_lines(spark, path, keep, F.lit(True))
    return rewrite.text_files(spark, path).count()
