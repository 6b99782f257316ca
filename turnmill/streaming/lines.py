"""Format audit of lines as they arrive.

Every check of a line is an expression over that line, so the batch definition applies to a
stream unchanged and keeps no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from turnmill.config import THAI, Script
from turnmill.functions.line_audit import audit_line
from turnmill.sources.jsonl import is_blank


def audit_arrivals(spark: SparkSession, folder: str, script: Script = THAI) -> DataFrame:
    """A streaming DataFrame of audited lines from text files dropped into `folder`."""
    arriving = spark.readStream.text(folder).select(
        F.col("_metadata.file_name").alias("corpus"), F.col("value").alias("line")
    )
    return audit_line(arriving.filter(~is_blank(F.col("line"))), "line", script)
