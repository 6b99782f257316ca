"""Whitening against plain numpy and Python integers."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from turnmill.llm.whitening import Whitening, whiten

SHAPE = "vec_id bigint, embedding array<float>, id string, x string, w string, copies string, component string"


def plain(rows, most=16, counted=False):
    """Per (id, component): n, deviation, |whitened|, explained."""
    grid = {}
    for ident, vector, *_ in rows:
        if vector is not None and all(c is not None and math.isfinite(c) for c in vector):
            x = tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector)
            grid.setdefault(x, []).append(ident)
    fit = list(grid)
    weights = [len(grid[x]) if counted else 1 for x in fit]
    n, d = sum(weights), len(fit[0])
    sums = [sum(w * x[k] for x, w in zip(fit, weights)) for k in range(d)]
    centred = np.array([[(n * x[k] - s) / n for k, s in enumerate(sums)] for x in fit])
    cov = (centred * np.array(weights)[:, None]).T @ centred / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    made = {}
    for x, row in zip(fit, centred):
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        for k in range(min(most, d)):
            if e[k] > e[0] * 1e-12:
                value = abs(row @ u[:, k]) / math.sqrt(e[k])
                for ident in grid[x]:
                    made.setdefault((ident, k + 1), []).append((n, deviation, value, e[k] / np.trace(cov)))
    return made


def check(spark, rows, how=Whitening(), counted=False):
    got = whiten(spark.createDataFrame(rows, SHAPE).repartition(3), how).collect()
    want = plain(rows, how.components, counted)
    assert len(got) == sum(map(len, want.values()))
    for row in got:
        n, deviation, value, explained = want[row["vec_id"], row["component"]][0]
        assert (row["n"], int(row["deviation"])) == (n, deviation)
        assert abs(row["whitened"]) == pytest.approx(value, rel=1e-6, abs=1e-7)
        assert row["explained"] == pytest.approx(explained, rel=1e-9)
        assert row["identity_error"] < 1e-9
    return got


def vectors(count, d, seed):
    draw = np.random.default_rng(seed)
    mix = draw.normal(size=(d, d)) * np.geomspace(3, 0.05, d)
    return [[float(c) for c in v] for v in draw.normal(size=(count, d)) @ mix + 2]


EXTRA = ("?",) * 5


def test_equals_numpy_with_copies_nulls_and_bad_entries(spark):
    made = vectors(300, 20, 1)
    rows = [(k, v) + EXTRA for k, v in enumerate(made)]
    rows += [(1000 + k, made[7]) + EXTRA for k in range(200)]  # a hot vector
    rows += [(5, made[5]) + EXTRA, (None, made[6]) + EXTRA]
    rows += [(2000, None) + EXTRA, (2001, [None] + made[0][1:]) + EXTRA]
    rows += [(2002, [float("nan")] + made[0][1:]) + EXTRA, (2003, [float("inf")] + made[0][1:]) + EXTRA]
    random.Random(2).shuffle(rows)
    check(spark, rows)


def test_counts_as_weights_and_few_dimensions(spark):
    made = vectors(40, 5, 3)
    rows = [(k, made[k % 40]) + EXTRA for k in range(57)]
    check(spark, rows, Whitening(weight="count"), counted=True)


def test_large_entries_stay_exact(spark):
    made = [[c * 1e7 for c in v] for v in vectors(30, 4, 4)]
    check(spark, [(k, v) + EXTRA for k, v in enumerate(made)])


def test_one_sign_for_all_rows(spark):
    made = vectors(60, 6, 5)
    got = whiten(spark.createDataFrame([(k, v) + EXTRA for k, v in enumerate(made)], SHAPE)).collect()
    by = {(r["vec_id"], r["component"]): r["whitened"] for r in got}
    table = np.array([[by[k, c] for c in range(1, 7)] for k in range(60)])
    assert np.abs(table.mean(axis=0)).max() < 1e-9
    assert np.abs(table.T @ table / 60 - np.eye(6)).max() < 1e-9


def test_tables_without_variance(spark):
    frame = lambda rows: spark.createDataFrame([r + EXTRA for r in rows], SHAPE)
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        found = whiten(frame(rows))
        assert found.columns == columns
        assert found.collect() == []


def test_lengths_that_differ_and_flat_dimensions(spark):
    rows = [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [1.0]), (4, [5.0, 2.0])]
    got = whiten(spark.createDataFrame([r + EXTRA for r in rows], SHAPE)).collect()
    assert sorted((r["vec_id"], r["component"], r["n"]) for r in got) == [(1, 1, 3), (2, 1, 3), (4, 1, 3)]
    assert all(r["explained"] == pytest.approx(1) for r in got)
