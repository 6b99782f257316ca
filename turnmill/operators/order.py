"""Exact order statistics and prefixes without a global sort."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from turnmill.session import materialize

BUCKET_DIGITS = 4  # 65,536 buckets of a hex key
FIRST_FILES = 4  # whose footers are read first for the head of a table
MAX_BROADCAST_ROWS = 10_000  # narrow rows, some megabytes


def small_side(table: DataFrame, most: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A stored table as one side of a join: with a broadcast hint if it has at most `most` rows,
    as it is if it has more."""
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table


def cutoffs(
    rows: DataFrame,
    groups: list[str],
    key: str,
    idents: list[str],
    k: Column,
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Where the first `k` rows of each group end, in `(key, idents)` order: a stored table of
    `groups, n_rows, k, cut`, in which `cut` is the k-th row's key and identifiers, or NULL if the
    group has fewer rows or `k` is 0.

    `key` is a uniform hex string; `k` may use `groups` and `n_rows`. Counting key prefixes (a
    combined hash aggregate, at most 16**digits rows per group) tells which prefix holds the
    k-th row, and only rows with that prefix are then ranked. Two passes over `rows`, which
    should be a stored table. Any number of groups; nothing is collected.
    """
    # Without groups the constant keeps joins and windows the same; it has one value only.
    own = groups or ["_all"]
    rows = rows if groups else rows.withColumn("_all", F.lit(0))
    rows = rows.withColumn("_prefix", F.substring(key, 1, digits))
    whole = Window.partitionBy(*own)
    running = whole.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = (
        rows.groupBy(*own, "_prefix")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(running))
        .withColumn("n_rows", F.sum("n").over(whole))
        .withColumn("k", k.cast("bigint"))
    )
    holds_kth = (F.col("upto") >= F.col("k")) & (F.col("upto") - F.col("n") < F.col("k"))
    places = materialize(
        counted.groupBy(*own, "n_rows", "k").agg(
            F.max(F.when(holds_kth, F.col("_prefix"))).alias("_prefix"),
            F.max(F.when(holds_kth, F.col("k") - F.col("upto") + F.col("n"))).alias("_rest"),
        ),
        "cut-places",
    )
    # Stored, so its real size decides whether it is broadcast.
    held = places.filter("_prefix is not null").select(*own, "_prefix", "_rest")
    found = (
        rows.select(*own, "_prefix", key, *idents)
        .join(held, [*own, "_prefix"])
        .withColumn("_rank", F.row_number().over(whole.orderBy(key, *idents)))
        .filter("_rank = _rest")
        .select(*own, F.struct(key, *idents).alias("cut"))
    )
    cuts = places.join(found, own, "left").select(*groups, "n_rows", "k", "cut")
    return materialize(cuts, "cuts")


def within_cut(
    key: str, idents: list[str], k: Column | None = None, cut: Column | None = None
) -> Column:
    """True for the first `k` rows, by the columns `k` and `cut` of `cutoffs` unless given."""
    k = F.col("k") if k is None else k
    cut = F.col("cut") if cut is None else cut
    return (k > 0) & (cut.isNull() | (F.struct(key, *idents) <= cut))


def keep_first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key. Spark limits each map task's output to one row per key before
    the shuffle, so a key shared by very many rows does not gather them."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_place", F.row_number().over(first)).filter("_place = 1").drop("_place")


def first_per_group(rows: DataFrame, groups: list[str], order: list[str], n: int) -> DataFrame:
    """The first `n` rows of each group, numbered from 1 in `place`."""
    place = Window.partitionBy(*groups).orderBy(*order)
    return rows.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= n)


def first_idents(rows: DataFrame, ident: str, n: int) -> Column:
    """The largest of the `n` smallest distinct identifiers, as a scalar subquery.

    A filter `ident <= first_idents(...)` reaches the scan as a pushed predicate.
    """
    smallest = fewest(rows.select(ident), n).distinct().orderBy(ident).limit(n)
    return smallest.agg(F.max(ident)).scalar()


def fewest(values: DataFrame, n: int) -> DataFrame:
    """At most `n` rows per task of a table of one column: the smallest distinct values each has, NULL aside."""

    names = values.columns

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            column = batch.column(0) if held is None else pa.concat_arrays([held, batch.column(0)])
            column = pc.unique(column).drop_null()
            held = column.take(pc.select_k_unstable(column, n, [("value", "ascending")])) if len(column) > n else column
        if held is not None:
            yield pa.RecordBatch.from_arrays([held], names=names)

    return values.mapInArrow(smallest, values.schema)


def first_stored(table: DataFrame, n: int) -> DataFrame:
    """The first `n` rows of a Parquet table as read, in storage order (file path, row index).

    Files are taken from the listing in that order, in growing batches, until their row counts, which
    Parquet footers give, cover `n`: at most `n` files with rows, and only those are read.
    """
    path = F.col("_metadata.file_path")
    files, starts, covered, batch = sorted(table.inputFiles()), [], 0, FIRST_FILES
    while files and covered < n:
        now, files = files[:batch], files[batch:]
        for name, rows in sorted(rows_per_file(table, now).items()):
            if covered < n:
                starts.append((name, covered))
            covered += rows
        batch *= 2
    if not starts:
        return table.limit(0).withColumns({"_file": F.lit(""), "_row": F.lit(0).cast("bigint")})
    # At most n rows, and few in practice.
    bounds = small_side(materialize(table.sparkSession.createDataFrame(starts, "_file string, _start bigint"), "head"))
    return (
        _files_of(table, [name for name, _ in starts])
        .select("*", path.alias("_file"), F.col("_metadata.row_index").alias("_row"))
        .join(bounds, "_file")
        .filter(F.col("_start") + F.col("_row") < n)
        .drop("_start")
        .select(*table.columns, "_file", "_row")
    )


def _files_of(table: DataFrame, files: list[str]) -> DataFrame:
    """Some of the files of a Parquet table, partition columns included."""
    base = re.split(r"/[^/=]+=[^/]*/", files[0])[0] if "=" in files[0] else None
    reader = table.sparkSession.read.schema(table.schema)
    return (reader.option("basePath", base) if base else reader).parquet(*[unquote(name) for name in files])


def rows_per_file(table: DataFrame, files: list[str]) -> dict[str, int]:
    """Rows of those of the files that have any."""
    name = F.col("_metadata.file_path").alias("_file")
    counted = _files_of(table, files).select(name).groupBy("_file").agg(F.count(F.lit(1)).alias("n"))
    return {row["_file"]: row["n"] for row in counted.collect()}


def ranked_values(
    rows: DataFrame,
    groups: list[str],
    value: str,
    picks: dict[str, Column],
    tallies: dict[str, Column],
) -> DataFrame:
    """Exact order statistics of an integer column.

    `picks` maps a name to a zero-based index, an expression over `n`, the rows of the group;
    `tallies` maps a name to a condition on the value whose rows are counted. Works on counts
    per distinct value, so each group's window is as small as its value range. Also gives `n`,
    `low`, `high` and `mean`.
    """
    running = (
        Window.partitionBy(*groups)
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    whole = Window.partitionBy(*groups)
    counted = (
        rows.groupBy(*groups, value)
        .agg(F.count(F.lit(1)).alias("_count"))
        .withColumn("_upto", F.sum("_count").over(running))
        .withColumn("n", F.sum("_count").over(whole))
    )
    total = F.sum(F.col(value) * F.col("_count"))
    return counted.groupBy(*groups).agg(
        F.max("n").alias("n"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        (total / F.max("n")).alias("mean"),
        *[
            F.min(F.when(F.col("_upto") > index, F.col(value))).alias(name)
            for name, index in picks.items()
        ],
        *[
            F.coalesce(F.sum(F.when(condition, F.col("_count"))), F.lit(0)).alias(name)
            for name, condition in tallies.items()
        ],
    )
