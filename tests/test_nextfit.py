"""Packing in one order against a plain loop, however rows are dealt into blocks."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from turnmill.operators import nextfit
from turnmill.operators.nextfit import block_step, compose, fill_bins, next_fit


def plain(lengths, capacity, used=None):
    """Bin of each item, and the last bin's content."""
    used, number, bins = (capacity + 1, -1, []) if used is None else (used, 0, [])
    for n in lengths:
        if used + n > capacity:
            used, number = 0, number + 1
        used += n
        bins.append(number)
    return bins, used, number


def lengths(draw, capacity):
    kinds = [lambda: draw.randint(0, capacity // 3), lambda: draw.randint(0, 2 * capacity), lambda: 0, lambda: capacity]
    return [draw.choice(kinds)() for _ in range(draw.randint(1, 40))]


def test_functions_of_blocks_and_of_neighbours():
    draw = random.Random(1)
    for _ in range(300):
        capacity = draw.choice([1, 5, 20])
        first, second = lengths(draw, capacity), lengths(draw, capacity)
        steps = [block_step(np.array(x), capacity) for x in (first, second)]
        both = compose(*steps, capacity)
        for own, made in ((first, steps[0]), (second, steps[1]), (first + second, both)):
            for entry in range(capacity + 2):
                bins, used, number = plain(own, capacity, entry)
                assert nextfit._entry(made, entry) == (min(used, capacity + 1), number)
                assert fill_bins(np.array(own), capacity, entry, 0).tolist() == bins


@pytest.mark.parametrize("block_rows,fan", [(10_000, 256), (40, 256), (3, 4), (1, 2)])
def test_bins_do_not_depend_on_blocks(spark, monkeypatch, block_rows, fan):
    monkeypatch.setattr(nextfit, "FAN", fan)
    draw, capacity = random.Random(2), 30
    rows = [(k, draw.choice([0, 3, 7, 12, 30, 31, 90]), hashlib.md5(str(k).encode()).hexdigest()) for k in range(150)]
    ordered = sorted(rows, key=lambda r: (r[2], r[0]))
    want = dict(zip([r[0] for r in ordered], plain([r[1] for r in ordered], capacity)[0]))
    frame = spark.createDataFrame(rows + [(999, None, "0" * 32)], "i bigint, n_tokens int, draw_key string").repartition(5)
    got = next_fit(frame, "i", capacity, block_rows).collect()
    assert {r["i"]: r["bin"] for r in got} == want
    assert all(r["oversized"] == (r["n_tokens"] > capacity) for r in got)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "i bigint, n_tokens int, draw_key string")
    assert next_fit(frame, "i", 10).collect() == []
