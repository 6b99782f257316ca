"""Contiguous shards of nearly equal byte size from global prefix sums.

Documents are ordered by (md5 of the text, id), so that equal texts lie together. Only narrow rows
(hash, id, size) are dealt out, by range: a task then holds one stretch of the order, and a text that
a third of the documents share is spread over many stretches by its ids. The size of everything
before a stretch comes from one total per stretch, so a row's global offset is that base plus a
running sum inside the stretch, and a cut is a comparison of the offset with a multiple of the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from turnmill.session import materialize

OVERHEAD = 16  # bytes counted for a document besides its text
SHARDS = 40
ROWS_PER_STRETCH = 250_000
SNAP = 64  # an equal-text group of up to target / SNAP bytes is not cut


def shard_by_bytes(
    docs: DataFrame,
    shards: int = SHARDS,
    ident: str = "doc_id",
    text: str = "text",
    stretches: int | None = None,
) -> DataFrame:
    """`doc_id, size, text_crc32, shard, slot` for every row of `docs`.

    A row belongs to the shard that holds the middle of its bytes, so a shard misses the target by
    less than one document at each end. Equal texts follow each other. A group of them that is
    small against the target is judged by its middle as a whole and so stays in one shard; a
    larger one is cut where the target falls. `slot` numbers the rows of a shard from 0 without
    gaps, in order.

    A null text has size 16 and null `text_crc32`; an empty text has crc 0. Null ids come first
    among equal texts. Repeated rows all stay, each with a slot of its own. Documents larger
    than a target may leave a shard without rows. An empty table gives an empty result. Columns other than
    the two named are not read.

    `stretches` is the number of range partitions; by default one for each 250,000 rows.
    """
    content = F.col(text)
    size = F.coalesce(F.octet_length(content), F.lit(0)).cast("bigint") + OVERHEAD
    # Stored before it is dealt out: the range bounds are sampled from it, and the row number that
    # orders repeated rows must not change when a task runs again.
    narrow = materialize(
        docs.select(
            F.col(ident).alias("doc_id"),
            size.alias("size"),
            F.crc32(content).alias("text_crc32"),
            F.md5(content).alias("_text"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "shard-sizes",
    )
    if stretches is None:
        stretches = max(8, -(-narrow.count() // ROWS_PER_STRETCH))
    order = ["_text", "doc_id", "_row"]
    dealt = materialize(
        narrow.repartitionByRange(stretches, *order).withColumn("_part", F.spark_partition_id()),
        "shard-stretches",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    # One row per stretch, whatever the number of documents in it.
    bases = (
        dealt.groupBy("_part")
        .agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
        .select(
            "_part",
            F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_base"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base_rows"),
            F.sum("_bytes").over(everything).alias("_total"),
        )
    )
    upto = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = materialize(
        dealt.withColumns(
            {
                "_inside": F.coalesce(F.sum("size").over(upto), F.lit(0)),
                "_rank": F.row_number().over(upto.rowsBetween(Window.unboundedPreceding, 0)) - 1,
            }
        )
        .join(F.broadcast(bases), "_part")
        .withColumns(
            {
                "_start": F.col("_base") + F.col("_inside"),
                "_place": F.col("_base_rows") + F.col("_rank"),
            }
        )
        .drop("_part", "_inside", "_rank", "_base", "_base_rows"),
        "shard-places",
    )
    # Groups of equal texts: where each begins and how long it is, combined before the shuffle.
    same = F.coalesce("_text", F.lit(""))
    groups = materialize(
        placed.groupBy(same.alias("_same"))
        .agg(
            F.min("_start").alias("_from"),
            F.sum("size").alias("_long"),
            F.count(F.lit(1)).alias("_n"),
            F.max("_total").alias("_all"),
        )
        .filter("_n > 1")
        .withColumn("_whole", F.col("_long") * shards * SNAP <= F.col("_all")),
        "shard-groups",
    )
    # Large groups number at most shards * SNAP. Their rows need nothing from the join below, so
    # each gets a key of its own there and no key has many rows.
    large = groups.filter("not _whole").select("_same", F.lit(True).alias("_large"))
    own = F.concat("_same", F.lit(":"), F.col("_place"))
    small = groups.filter("_whole").select(F.col("_same").alias("_key"), "_from", "_long")
    with_groups = (
        placed.withColumn("_same", same)
        .join(F.broadcast(large), "_same", "left")
        .withColumn("_key", F.when(F.col("_large"), own).otherwise(F.col("_same")))
        .join(small, "_key", "left")
    )
    own_middle = 2 * F.col("_start") + F.col("size")
    middle = F.coalesce(2 * F.col("_from") + F.col("_long"), own_middle)
    # Whole-number division, exact up to 2**63 / (2 * shards) bytes.
    cut = F.expr(f"cast(least((_middle * {shards}) div (2 * _total), {shards - 1}) as int)")
    sharded = materialize(
        with_groups.withColumn("_middle", middle).select(
            "doc_id", "size", "text_crc32", cut.alias("shard"), "_place"
        ),
        "shard-cuts",
    )
    # At most `shards` rows.
    firsts = sharded.groupBy("shard").agg(F.min("_place").alias("_first"))
    return sharded.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("_place") - F.col("_first")).alias("slot"),
    )
