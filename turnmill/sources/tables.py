"""Parquet sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from turnmill.sources.types import reconciled


def load_split(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_matching(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """All Parquet tables or files in `root` whose name matches, whatever columns each has.

    Columns of one name with different types are brought to one (`sources.types`).
    """
    path = f"{root}/{glob}"
    try:
        return _merged(spark, [path])
    except (PySparkException, Py4JJavaError) as error:
        if not _is_conflict(error):
            raise
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).inputFiles()
    parts = _mergeable(spark, [name for name in sorted(files) if not name.endswith(".crc")])
    return union_splits(*parts)


def _merged(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(*paths)


def _is_conflict(error: Exception) -> bool:
    # The condition is in the text; not every path gives the error a class of its own.
    return "[CANNOT_MERGE" in str(error)


def _mergeable(spark: SparkSession, files: list[str]) -> list[DataFrame]:
    """Tables of files whose types agree, by halving the list where they do not."""
    try:
        return [_merged(spark, files)]
    except (PySparkException, Py4JJavaError) as error:
        if len(files) == 1 or not _is_conflict(error):
            raise
    half = len(files) // 2
    return _mergeable(spark, files[:half]) + _mergeable(spark, files[half:])


def save_if_absent(df: DataFrame, path: str) -> None:
    df.write.mode("ignore").parquet(path)


def union_splits(*splits: DataFrame, key: str | None = None, ident: str = "id") -> DataFrame:
    """All rows of splits whose columns differ; missing columns become NULL, and columns of one name
    with different types get one they share (`sources.types`).

    `key` names a column that is added: the split's place and `ident`, which is unique over
    the splits where `ident` is unique in each.
    """
    if key:
        splits = tuple(
            split.withColumn(key, F.concat_ws(":", F.lit(str(place)), F.col(ident).cast("string")))
            for place, split in enumerate(splits)
        )
    first, *rest = reconciled(list(splits))
    for split in rest:
        first = first.unionByName(split, allowMissingColumns=True)
    return first


def prompt_as_messages(split: DataFrame) -> DataFrame:
    """A split that calls its conversation `prompt`; rows without one are left out."""
    return split.filter(F.size("prompt") > 0).withColumnRenamed("prompt", "messages")


def split_inventory(spark: SparkSession, catalogue: Mapping[str, str]) -> DataFrame:
    """`name, present, n_rows, columns` per catalogued split; a missing one has NULL counts."""
    shape = "name string, present boolean, n_rows bigint, columns string"
    found = spark.createDataFrame([], shape)
    for name, path in catalogue.items():
        try:
            split = spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            row = spark.range(1).select(
                F.lit(name).alias("name"),
                F.lit(False).alias("present"),
                F.lit(None).cast("bigint").alias("n_rows"),
                F.lit(None).cast("string").alias("columns"),
            )
        else:
            row = split.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("name"),
                F.lit(True).alias("present"),
                "n_rows",
                F.lit(",".join(split.columns)).alias("columns"),
            )
        found = found.unionByName(row)
    return found
