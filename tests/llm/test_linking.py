"""Links inside buckets against all pairs, and how many are returned."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from turnmill.llm import linking
from turnmill.llm.linking import Blocks, link_classes
from turnmill.llm.neardup import counted
from turnmill.llm.ngram_join import divide_skip


def family(draw, base, count, changed):
    """Sets that differ from `base` in `changed` elements of their own."""
    made = []
    for _ in range(count):
        kept = draw.permutation(base)[changed:]
        made.append(np.unique(np.concatenate([kept, draw.integers(1 << 40, 1 << 60, changed).astype(np.uint64)])))
    return made


def exact_labels(sets, shared, percent):
    """The smallest member of each component of all pairs that `shared` allows."""
    every = np.unique(np.concatenate(sets))
    table = np.zeros((len(sets), len(every)), np.float32)
    for k, values in enumerate(sets):
        table[k, np.searchsorted(every, values)] = 1
    common = (table @ table.T).astype(np.int64)
    size = np.array([len(s) for s in sets])
    near = (100 * common >= percent * (size[:, None] + size - common)) & shared
    label = np.arange(len(sets))
    while True:
        lower = np.where(near, label, len(sets)).min(axis=1)
        lower = lower[lower]
        if (lower == label).all():
            return label
        label = lower


def run(spark, sets, buckets, percent, monkeypatch, search=counted, blocks=Blocks()):
    """Labels found, and the number of links that tasks returned."""
    rows = [(b, k, len(sets[k])) for b, members in enumerate(buckets) for k in members]
    spread = spark.createDataFrame(rows, "bucket bigint, cid bigint, n bigint").repartition(4)
    known = spark.createDataFrame([(k, s.tobytes()) for k, s in enumerate(sets)], "cid bigint, hashes binary")
    totals, searched = [], linking._search

    def count(*given):
        found = searched(*given)
        totals.append(found.count())
        return found

    monkeypatch.setattr(linking, "_search", count)
    found = link_classes(spread, lambda wanted, n: known, search(percent), len(rows), blocks)
    got = {r["node"]: r["label"] for r in found.collect()}
    return np.array([got.get(k, k) for k in range(len(sets))]), sum(totals)


def together(sets, buckets):
    shared = np.eye(len(sets), dtype=bool)
    for members in buckets:
        shared[np.ix_(members, members)] = True
    return shared


def test_copies_far_from_their_head_give_few_links(spark, monkeypatch):
    """600 near copies in one bucket, none of them near its head."""
    draw = np.random.default_rng(1)
    base = draw.integers(1, 1 << 40, 100).astype(np.uint64)
    sets = family(draw, base, 1, 40) + family(draw, base, 599, 6)
    got, links = run(spark, sets, [list(range(600))], 75, monkeypatch)
    assert (got == exact_labels(sets, together(sets, [range(600)]), 75)).all()
    assert got.tolist() == [0] + [1] * 599
    assert links < 1200


@pytest.mark.parametrize("search", [counted, divide_skip])
def test_a_large_bucket_of_several_families(spark, monkeypatch, search):
    """3,000 classes: families whose members are near each other but not to the head, and loose ones."""
    draw = np.random.default_rng(2)
    common = draw.integers(1, 1 << 40, 60).astype(np.uint64)
    sets = family(draw, common, 1, 30)
    for count, changed in [(1500, 4), (900, 5), (400, 8), (199, 30)]:
        base = np.concatenate([common, draw.integers(1, 1 << 40, 40).astype(np.uint64)])
        sets += family(draw, base, count, changed)
    buckets = [list(range(3000))]
    got, links = run(spark, sets, buckets, 75, monkeypatch, search)
    assert (got == exact_labels(sets, together(sets, buckets), 75)).all()
    assert links < 40_000


def test_many_small_buckets(spark, monkeypatch):
    """All links inside buckets are found, whatever the blocks, and none between sets that are not similar.

    Members of a group may be linked without a bucket in common.
    """
    draw = np.random.default_rng(3)
    sets = []
    for _ in range(30):
        base = draw.integers(1, 1 << 40, 50).astype(np.uint64)
        sets += family(draw, base, 8, 3) + family(draw, base, 2, 9)
    buckets = [sorted(set(draw.integers(0, len(sets), 5).tolist())) for _ in range(60)]
    buckets += [sorted({10 * f + int(k) for k in draw.integers(0, 10, draw.integers(2, 9))}) for f in range(30) for _ in range(4)]
    buckets += [buckets[-1], [7]]
    least = exact_labels(sets, together(sets, buckets), 75)
    most = exact_labels(sets, np.ones((len(sets), len(sets)), bool), 75)
    for blocks in (Blocks(rows=3, pivots=1), Blocks(elements=120, whole=1)):
        with monkeypatch.context() as patch:
            got, _ = run(spark, sets, buckets, 75, patch, blocks=blocks)
        assert (got[least] == got).all()
        assert (most[got] == most).all()


def test_no_shared_bucket(spark, monkeypatch):
    got, links = run(spark, [np.arange(5, dtype=np.uint64)] * 2, [[0], [1]], 75, monkeypatch)
    assert got.tolist() == [0, 1] and links == 0


@pytest.mark.parametrize("sizes", [[7], [1, 3, 2], [40], [2, 2, 2, 2, 2]])
def test_runs_of_buckets_over_batches(sizes):
    """Rows of buckets with several classes, wherever batches end."""
    draw = np.random.default_rng(6)
    for _ in range(200):
        bucket = np.sort(draw.integers(0, draw.integers(1, 30), draw.integers(0, 40)))
        cid = np.arange(len(bucket)) * 3 + 5
        rows = pa.RecordBatch.from_arrays([pa.array(x) for x in (bucket, cid, cid * 2)], ["bucket", "cid", "n"])
        batches, start = [], 0
        while start < len(bucket):
            size = sizes[len(batches) % len(sizes)]
            batches.append(rows.slice(start, size))
            start += size
        got = [tuple(r.values()) for b in linking._shared(iter(batches)) for r in b.to_pylist()]
        want = [
            (int(b), int(c), int(2 * c), int(cid[bucket == b][0])) for b, c in zip(bucket, cid) if (bucket == b).sum() > 1
        ]
        assert got == want


def test_large_buckets_take_another_way(spark, monkeypatch):
    monkeypatch.setattr(linking, "OFTEN", 20)
    rows = [(b, c, 1) for b in range(30) for c in range(b, b + (50 if b < 3 else b % 3))]
    spread = spark.createDataFrame(rows, "bucket bigint, cid bigint, n bigint").repartition(3)
    got = sorted(tuple(r) for r in linking._members(spread, len(rows)).collect())
    sizes = {b: sum(r[0] == b for r in rows) for b in range(30)}
    assert got == sorted((b, c, n, b) for b, c, n in rows if sizes[b] > 1)
