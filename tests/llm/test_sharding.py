"""Byte-balanced shards against the law and a plain recomputation."""

from __future__ import annotations

import zlib

import pytest

from turnmill.llm.sharding import shard_by_bytes


def check(rows, docs, shards):
    want = sorted(
        ((d["doc_id"], len((d["text"] or "").encode()) + 16, None if d["text"] is None else zlib.crc32(d["text"].encode())) for d in docs),
        key=repr,
    )
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=repr) == want
    slots, sizes = {}, {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    assert set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


@pytest.mark.parametrize("stretches", [1, 3, 8])
def test_awkward_rows(awkward, stretches):
    check(shard_by_bytes(awkward, 5, stretches=stretches).collect(), awkward.collect(), 5)


def test_empty_table(nothing):
    assert shard_by_bytes(nothing).collect() == []


def test_sizes_are_near_the_target_and_small_groups_stay_whole(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i % 400} " + "x" * (i % 90)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    found = shard_by_bytes(docs, 10, stretches=9).collect()
    sizes = check(found, docs.collect(), 10)
    target = sum(sizes.values()) / 10
    assert all(abs(s - target) <= 0.03 * target for s in sizes.values())
    by_id = {r["doc_id"]: r["shard"] for r in found}
    groups = {}
    for ident, text in rows:
        groups.setdefault(text, set()).add(by_id[ident])
    assert len(groups["same text"]) > 1  # a third of all rows: cut where the target falls
    assert all(len(s) == 1 for t, s in groups.items() if t != "same text")


def test_plan_has_no_python(awkward):
    plan = shard_by_bytes(awkward, 5)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
