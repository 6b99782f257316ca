"""Helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnmill.session import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(ident: str, divisor: int) -> Column:
    """crc32 of the identifier as text, modulo `divisor`; a null counts as empty text."""
    text = F.coalesce(F.col(ident).cast("string"), F.lit(""))
    return F.crc32(text) % divisor


def free_name(df: DataFrame, wish: str) -> str:
    """`wish`, made longer until no column of `df` has it (names compare without case)."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


ROWS_A_TASK = 500_000  # of narrow rows


def tasks_for(spark: SparkSession, rows: int, a_task: int = ROWS_A_TASK) -> int:
    """How many tasks a table of `rows` rows needs, but one per core."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // a_task))


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """`df`, which has about `rows` narrow rows, in no more partitions than they need; as it is where a
    shuffle makes no more. A shuffle of its own, since tasks of merged partitions would hold the
    memory of all their joins at once."""
    spark = df.sparkSession
    tasks = tasks_for(spark, rows)
    return df.repartition(tasks) if tasks < int(spark.conf.get("spark.sql.shuffle.partitions")) else df


def hash_share(ident: str, wanted: int, out_of: int) -> Column:
    """True for a share `wanted / out_of` of the identifiers, chosen by their hash."""
    share = min(1.0, wanted / max(out_of, 1))
    return F.pmod(F.xxhash64(F.col(ident).cast("string")), F.lit(1 << 30)) < int(share * (1 << 30))


def one_label(labels: DataFrame, ident: str, label: str) -> DataFrame:
    """`ident, label`, one row per identifier: rows with a null in either are left out, and of
    several labels the largest counts."""
    known = labels.filter(F.col(ident).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(ident).agg(F.max(label).cast("int").alias(label))
