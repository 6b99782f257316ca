"""Nearest neighbours by collision counting (one projection per hash, windows centred on the query).

Every vector is projected on a few random lines, and the values on each line are sorted once. For a
query, windows of the same radius around its own projections are widened step by step (virtual
rehashing); a vector that lies inside the windows of enough lines is verified by its exact
inner product. The search ends when the k-th best is nearer than the radius: what is nearer still has
with high probability been in enough windows. Largest inner product becomes nearest distance
by one more coordinate that gives all vectors the same length.

Vectors and queries are dealt into blocks, and each pair of blocks is one group of a bounded size; the best
of the groups are merged by rank.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from turnmill.session import materialize


@dataclass(frozen=True)
class Collision:
    lines: int = 32
    share: float = 0.5  # of the lines whose window must hold a vector
    start: float = 0.6  # first radius, in units of the vectors' length
    growth: float = 1.2
    block: int = 8_192  # vectors in a group
    queries: int = 1_024  # queries in a group
    seed: int = 17


class Index:
    """Sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, how: Collision) -> None:
        draw = np.random.default_rng(how.seed)
        self.how, self.ids, self.vectors, self.longest = how, ids, vectors, longest
        self.lines = draw.standard_normal((vectors.shape[1] + 1, how.lines))
        rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0))
        at = (vectors @ self.lines[:-1] + rest[:, None] * self.lines[-1]).T
        self.order = np.argsort(at, axis=1)
        # All lines in one sorted array, each moved into a range of its own.
        self.wide = 4 * np.abs(at).max() + 1
        self.offset = np.arange(how.lines) * self.wide
        self.flat = (np.take_along_axis(at, self.order, axis=1) + self.offset[:, None]).ravel()
        self.order = self.order.ravel()
        self.first = np.arange(how.lines) * len(ids)

    def _exact(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Inner products, summed in the same way for every row: equal vectors score alike."""
        return (self.vectors[at] * query).sum(axis=1)

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids and scores of the `k` best found, without id `own`."""
        how, n = self.how, len(self.ids)
        # Scaling a query keeps the order of its candidates.
        query_at = query * (self.longest / np.sqrt((query**2).sum()))
        centre = np.clip(query_at @ self.lines[:-1], -self.wide / 4, self.wide / 4) + self.offset
        need = max(1, int(np.ceil(how.share * how.lines)))
        counts, done = np.zeros(n, np.int64), self.ids == own
        places, likeness = [], []
        radius = how.start * self.longest
        low = high = np.searchsorted(self.flat, centre)
        while True:
            reach = min(radius, self.wide / 2)  # beyond it a window covers its whole line
            lower = np.maximum(np.searchsorted(self.flat, centre - reach, "left"), self.first)
            upper = np.minimum(np.searchsorted(self.flat, centre + reach, "right"), self.first + n)
            new = [self.order[a:b] for a, b in zip(lower, low)]
            new += [self.order[a:b] for a, b in zip(high, upper)]
            low, high = lower, upper
            counts += np.bincount(np.concatenate(new), minlength=n)
            at = np.flatnonzero((counts >= need) & ~done)
            if len(at):
                done[at] = True
                places.append(at)
                likeness.append(self.vectors[at] @ query_at)
            everything = reach < radius
            have = sum(map(len, places))
            if everything and not have:
                return self.ids[:0], np.zeros(0)
            if everything or have >= k:
                at, like = np.concatenate(places), np.concatenate(likeness)
                last = np.partition(like, -k)[-k] if have >= k else -np.inf
                if everything or 2 * self.longest**2 - 2 * last <= radius**2:
                    # Verify all that rounding could put among the best.
                    at = at[like >= last - 1e-9 * self.longest**2]
                    score = self._exact(at, query)
                    best = np.lexsort((self.ids[at], -score))[:k]
                    return self.ids[at[best]], score[best]
            radius *= how.growth


def _usable(vectors: DataFrame, ident: str, vector: str) -> DataFrame:
    """`id, v`: one row per id, in double precision."""
    real = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col("v")
    return (
        vectors.select(F.col(ident).alias("id"), F.col(vector).cast("array<double>").alias("v"))
        .filter(F.col("id").isNotNull() & v.isNotNull())
        .filter(F.forall(v, real) & F.exists(v, lambda x: x != 0))
        .groupBy("id")
        .agg(F.min("v").alias("v"))
    )


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    how: Collision = Collision(),
    ident: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """`query_id, rank, vec_id, score`: for every query its `k` nearest by inner product.

    `is_query` is a condition on the column `id`. Candidates are all rows but the query's own;
    where fewer than `k` have its number of components, it gets all of them. Equal scores are
    ordered by id. Rows with a null id, and vectors that are null, empty, all zero or hold a null or
    non-finite component take no part. Of rows that share an id the smallest vector counts. Vectors of
    different lengths are not compared. An empty table gives an empty result.
    """
    usable = materialize(_usable(vectors, ident, vector), "ann-vectors").withColumn("dim", F.size("v"))
    longest = F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x))
    by_dim = usable.withColumn("q", is_query.cast("int")).groupBy("dim")
    sizes = by_dim.agg(
        F.count(F.lit(1)).alias("n"), F.sum("q").alias("n_q"), F.max(longest).alias("longest")
    )
    n_blocks = F.ceil(F.col("n") / how.block).cast("int").alias("blocks")
    n_groups = F.ceil(F.greatest("n_q", F.lit(1)) / how.queries).cast("int").alias("groups")
    # One row for each number of components.
    sizes = materialize(sizes.select("dim", "longest", n_blocks, n_groups), "ann-sizes")
    known = usable.join(sizes, "dim")
    part = lambda salt, of: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    rows = known.withColumn("block", part(1, "blocks")).withColumn("g", every("groups"))
    asked = known.filter(is_query).withColumn("g", part(2, "groups")).withColumn("block", every("blocks"))

    def search(key, block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if block.empty or queries.empty:
            return empty.astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        index = Index(
            block["id"].to_numpy(), np.stack(block["v"].to_numpy()), block["longest"].iloc[0], how
        )
        made = []
        for own, query in zip(queries["q_id"], queries["q_v"]):
            ids, scores = index.search(own, np.asarray(query), k)
            made.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores}))
        return pd.concat(made)

    keys = ["dim", "block", "g"]
    # New names on one side, as both come from the same table.
    asked = asked.select(*[F.col(c).alias(f"q_{c}") for c in [*keys, "id", "v"]])
    found = (
        rows.select(*keys, "id", "v", "longest")
        .groupBy(keys)
        .cogroup(asked.groupBy([f"q_{c}" for c in keys]))
        .applyInPandas(search, "query_id bigint, vec_id bigint, score double")
    )
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranks))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
