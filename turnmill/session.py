"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

WORK_DIR_CONF = "spark.checkpoint.dir"

# Runtime SQL settings that results (first group) or plans (second group) rely on.
RUNTIME_CONF = {
    "spark.sql.variant.allowDuplicateKeys": "true",  # last of two equal keys wins
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where a grouping follows: one long conversation is worth an extra shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rows hold whole texts, so a batch of the default 10,000 may be very large.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}

_LOCAL_WORK_DIRS: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("turnmill")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def work_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`.

    Only a local session may go without one: it gets a temporary folder of its own.
    """
    named = spark.conf.get(WORK_DIR_CONF, None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set {WORK_DIR_CONF} to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_WORK_DIRS:
        _LOCAL_WORK_DIRS[app] = tempfile.mkdtemp(prefix="turnmill-")
    return _LOCAL_WORK_DIRS[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Used where several later steps need the same rows: the text is scanned once, column pruning
    and size statistics work on the copy, and a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
