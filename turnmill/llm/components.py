"""Connected components of links between nodes, as joins and combined minima."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from turnmill.llm.common import few_tasks
from turnmill.session import materialize

MAX_ROUNDS = 60
CHUNK = 1 << 20  # links contracted at once


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars `node, root` of the same components: the root is the smallest node that is linked here."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        lower = label.copy()
        for ends in (x, y, label[x], label[y]):
            np.minimum.at(lower, ends, low)
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _contracted(links: DataFrame) -> DataFrame:
    """As few links with the same components, as a task sees them: chunk by chunk."""

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= CHUNK:
                yield _star(held)
                held, rows = [], 0
        if rows:
            yield _star(held)

    def _star(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        node, root = contract(table.column("u").to_numpy(), table.column("v").to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["u", "v"])

    return links.mapInArrow(stars, "u bigint, v bigint")


def components(links: DataFrame, a: str = "a", b: str = "b", rows: int | None = None) -> DataFrame:
    """`node, label`: the smallest node reachable, for every node that has a link. Nodes are integers.

    Tasks first contract the links they read to stars. Then each round takes the smallest label among neighbours
    and the label that the own label had, so paths shrink by halves; a round is stored, which cuts the
    lineage. Minima are combined before the shuffle, so a node with very many links is no hot key. Ends when no
    label changes. `rows` tells about how many nodes there are, if known, and so how many partitions they need.
    """
    few = (lambda df: few_tasks(df, rows)) if rows is not None else (lambda df: df)
    forth = _contracted(links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v"))
    edges = forth.union(forth.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = materialize(few(edges.distinct()), "cc-edges")
    labels = materialize(
        few(
            edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least"))
            .select("node", F.least("node", "least").alias("label"))
        ),
        "cc-labels",
    )
    for _ in range(MAX_ROUNDS):
        near = (
            edges.join(labels.withColumnRenamed("node", "v"), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        lower = labels.join(near, "node").join(jump, "label", "left").select(
            "node",
            F.col("label").alias("old"),
            F.least("label", "near", F.coalesce("far", "label")).alias("label"),
        )
        lower = materialize(few(lower), "cc-labels")
        labels = lower.select("node", "label")
        if not lower.filter("label <> old").limit(1).count():
            return labels
    raise RuntimeError(f"labels still change after {MAX_ROUNDS} rounds")
