"""Components against exact set similarity of all pairs on small tables."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from turnmill.llm.components import components
from turnmill.llm.neardup import MinMax, Signer, near_duplicates, shingles

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def exact_sets(text):
    words = WORD.findall((text or "").translate(FOLD))
    n = min(len(words), 5)
    return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if words else frozenset()


def exact_components(rows):
    sets = [(ident, exact_sets(text)) for ident, text in rows]
    root = {ident: ident for ident, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {ident: (len(s), find(ident)) for ident, s in sets}


def check(spark, rows, how=MinMax()):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    want = exact_components(rows)
    for row in near_duplicates(docs, how).collect():
        assert (row["n_shingles"], row["component_id"]) == want[row["doc_id"]]
        assert row["kept"] == (row["doc_id"] == row["component_id"])


def edited(draw, words, share):
    return [draw.choice("pqrst") * 6 if draw.random() < share else w for w in words]


def test_chains_stars_and_borderline_pairs(spark):
    """Groups around a base, chains whose ends differ, shared passages, copies in other case."""
    draw = random.Random(3)
    word = lambda: "".join(draw.choices("abcdefghij", k=5))
    passage = [word() for _ in range(40)]
    rows, ident = [], 0
    for _ in range(6):
        base = [word() for _ in range(draw.randint(60, 150))]
        group = [base] + [edited(draw, base, draw.choice([0.01, 0.02, 0.03, 0.05])) for _ in range(12)]
        chain = base
        for _ in range(6):
            chain = chain[4:] + [word() for _ in range(4)]
            group.append(chain)
        for words in group:
            rows.append((ident, " ".join(words)))
            ident += 1
            if draw.random() < 0.3:
                rows.append((ident, " ".join(words).upper() + " "))
                ident += 1
    for _ in range(20):
        rows.append((ident, " ".join(passage + [word() for _ in range(60)])))
        ident += 1
    rows += [(ident, "a b"), (ident + 1, "A\tb"), (ident + 2, "a b c"), (ident + 3, None), (ident + 4, " ")]
    draw.shuffle(rows)
    check(spark, rows)


def test_short_drift_chains(spark):
    """Neighbours in a chain that have their head in common, and the head in another cluster."""
    draw, rows = random.Random(11), []
    for chain in range(150):
        start = 0
        for _ in range(draw.randint(4, 6)):
            rows.append((len(rows), " ".join(f"c{chain}w{k}" for k in range(start, start + 84))))
            start += draw.randint(7, 20)
    check(spark, rows)


def test_awkward_rows_and_empty_table(awkward, nothing):
    found = near_duplicates(awkward).collect()
    assert len(found) == awkward.count()
    for row in found:
        if row["n_shingles"] == 0 or row["component_id"] is None:
            assert row["kept"]
    plain = {r["doc_id"]: r["text"] for r in awkward.filter("doc_id is not null").collect()}
    want = exact_components(sorted(plain.items()))
    for row in found:
        if row["doc_id"] is not None:
            assert (row["n_shingles"], row["component_id"]) == want[row["doc_id"]]
    assert near_duplicates(nothing).collect() == []


def test_signatures_estimate_similarity():
    signer, draw = Signer(MinMax()), random.Random(2)
    words = [str(draw.random()) for _ in range(900)]
    left, right = shingles(" ".join(words[:800])), shingles(" ".join(words[60:860]))
    same = len(np.intersect1d(left, right)) / len(np.union1d(left, right))
    agree = (signer.bands(left) == signer.bands(right)).mean()
    assert same == pytest.approx(0.86, abs=0.02)
    assert agree == pytest.approx(same**5, abs=0.2)
    assert (signer.bands(left) == signer.bands(left.copy())).all()


def test_components_of_a_long_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(1000, k) for k in range(1001, 1100)] + [(5, 5)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    labels = {r["node"]: r["label"] for r in found.collect()}
    assert all(labels[k] == 0 for k in range(41))
    assert all(labels[k] == 1000 for k in range(1000, 1100))
