"""Sequence-packing plan: which conversations share a fixed-length training sequence."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from turnmill.config import EFFECTIVE_BATCH, PACKED_LENGTH

SHARDS = 64
KEY_DIGITS = 12  # 48 bits of the draw key place a row in a shard


def _fill(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each length when a bin is closed as soon as the next item does not fit."""
    ends = np.cumsum(lengths)
    bins = np.empty(len(lengths), dtype=np.int64)
    start, used, number = 0, 0, 0
    while start < len(lengths):
        stop = max(int(np.searchsorted(ends, used + capacity, side="right")), start + 1)
        bins[start:stop] = number
        used, start, number = ends[stop - 1], stop, number + 1
    return bins


def packing_plan(
    rows: DataFrame,
    ident: str,
    capacity: int = PACKED_LENGTH,
    shards: int = SHARDS,
) -> DataFrame:
    """Bins for rows `ident, n_tokens, draw_key`: `ident, n_tokens, shard, bin, oversized`.

    Draw order is cut into `shards` equal ranges of the draw key, and the only sequential work
    is inside a shard of three narrow columns. The number of shards does not follow the table, so
    a row more or less changes the bins of its own shard alone; give a large table more shards
    (tens of thousands of rows each are little work). Next-fit closes a bin when the next
    item does not fit; an item over `capacity` gets a bin alone.
    """
    narrow = rows.select(ident, F.col("n_tokens").cast("bigint"), "draw_key")
    # The leading bits of a uniform key, scaled to 0..shards-1, keep shards in key order.
    place = F.conv(F.substring("draw_key", 1, KEY_DIGITS), 16, 10).cast("double")
    shard = F.floor(place * F.lit(float(shards)) / F.lit(float(16**KEY_DIGITS)))
    narrow = narrow.withColumn("shard", shard)

    def pack(shard_rows: pd.DataFrame) -> pd.DataFrame:
        ordered = shard_rows.sort_values(["draw_key", ident], ignore_index=True)
        ordered["bin"] = _fill(ordered["n_tokens"].to_numpy(), capacity)
        return ordered[[ident, "n_tokens", "shard", "bin"]]

    schema = f"`{ident}` {dict(rows.dtypes)[ident]}, n_tokens bigint, shard bigint, bin bigint"
    return (
        narrow.groupBy("shard")
        .applyInPandas(pack, schema)
        .withColumn("oversized", F.col("n_tokens") > capacity)
    )


def packing_report(
    plan: DataFrame, capacity: int = PACKED_LENGTH, effective_batch: int = EFFECTIVE_BATCH
) -> DataFrame:
    """`conversations, bins, oversized, tokens, fill, steps_per_epoch` of a plan."""
    per_bin = plan.groupBy("shard", "bin").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("n_tokens").alias("tokens"),
        F.count_if("oversized").alias("oversized"),
    )
    bins = F.count(F.lit(1))
    return per_bin.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("conversations"),
        bins.alias("bins"),
        F.coalesce(F.sum("oversized"), F.lit(0)).alias("oversized"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
        (F.sum(F.least("tokens", F.lit(capacity))) / (bins * F.lit(float(capacity)))).alias("fill"),
        F.ceil(bins / F.lit(effective_batch)).alias("steps_per_epoch"),
    )
