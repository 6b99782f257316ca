"""Collision counting against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnmill.llm.ann import Collision, nearest


def exact(ids, vectors, k):
    made = {}
    for ident, vector in zip(ids, vectors):
        if ident % 5:
            continue
        scores = (vectors * vector).sum(axis=1)
        order = [p for p in np.lexsort((ids, -scores)) if ids[p] != ident][:k]
        made[ident] = [(ids[p], scores[p]) for p in order]
    return made


def table(spark, ids, vectors):
    rows = [(int(i), [float(x) for x in v], 0) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score int").repartition(4)


@pytest.mark.parametrize("spread", [0.0, 0.6])
def test_recall_and_scores(spark, spread):
    """Vectors of one length and of many lengths, in small blocks."""
    draw = np.random.default_rng(4)
    vectors = draw.standard_normal((900, 24))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors *= np.exp(spread * draw.standard_normal((900, 1)))
    vectors = vectors.astype(np.float32).astype(float)
    ids = draw.permutation(900)
    want = exact(ids, vectors, 10)
    found = nearest(table(spark, ids, vectors), F.col("id") % 5 == 0, 10, Collision(block=300, queries=50))
    got = {}
    for row in found.orderBy("query_id", "rank").collect():
        got.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
    assert set(got) == set(want)
    hits = 0
    for ident, rows in want.items():
        hits += len({i for i, _ in rows} & {i for i, _ in got[ident]})
        assert len(got[ident]) == 10
        assert [s for _, s in got[ident]] == sorted((s for _, s in got[ident]), reverse=True)
        place = {i: v for i, v in zip(ids, vectors)}
        for other, score in got[ident]:
            assert score == pytest.approx(float(place[other] @ place[ident]), rel=1e-12, abs=1e-12)
    assert hits >= 0.95 * 10 * len(want)


def test_ties_repeats_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [1.0, 0.0]) for k in range(30)] + [(3, [1.0, 0.0])]
    rows += [(40, None), (41, []), (42, [0.0, 0.0]), (43, [nan, 1.0]), (44, [inf, 1.0]), (45, [None, 1.0])]
    rows += [(None, [1.0, 0.0]), (50, [1.0, 2.0, 3.0]), (55, [3.0, 2.0, 1.0]), (60, [5.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {}
    for row in nearest(vectors, F.col("id") % 5 == 0, 4).orderBy("query_id", "rank").collect():
        got.setdefault(row["query_id"], []).append(row["vec_id"])
    assert got[0] == [1, 2, 3, 4]
    assert got[25] == [0, 1, 2, 3]
    assert got[50] == [55] and got[55] == [50]
    assert 60 not in got and 45 not in got


def test_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert nearest(empty, F.col("id") % 5 == 0).collect() == []
