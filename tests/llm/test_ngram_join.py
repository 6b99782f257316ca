"""Components of the join against exact similarity of all pairs, and the parts of its search."""

from __future__ import annotations

import random

import numpy as np

from test_neardup import WORD, FOLD, edited
from turnmill.llm.ngram_join import NgramJoin, differences, divide_skip, ngram_components, parts, size_class


def exact_sets(text, width=3):
    words = WORD.findall((text or "").translate(FOLD))
    n = min(len(words), width)
    return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if words else frozenset()


def exact_components(rows, percent=90, width=3):
    sets = [(ident, exact_sets(text, width)) for ident, text in rows]
    label = {ident: ident for ident, _ in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(a), find(b)))
                label[high] = low
    return {ident: (len(s), find(ident)) for ident, s in sets}


def check(spark, rows, how=NgramJoin()):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    want = exact_components(rows, how.percent, how.width)
    got = ngram_components(docs, how).collect()
    assert len(got) == len(rows)
    for row in got:
        assert (row["n_shingles"], row["component_id"]) == want[row["doc_id"]]


def groups(draw):
    """Copies with few changes around the limit, drift chains, short texts, a passage in common."""
    word = lambda: "".join(draw.choices("abcdefghij", k=4))
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(14):
        base = [word() for _ in range(draw.choice([8, 10, 12, 13, 25, 60, 150, 400]))]
        texts += [base] + [edited(draw, base, draw.choice([0.004, 0.01, 0.02, 0.03])) for _ in range(9)]
        chain = base
        for _ in range(5):
            chain = chain[1:] + [word()]
            texts.append(chain)
        texts += [base[:-1], base[1:], base + [word()]]
    texts += [passage + [word() for _ in range(draw.randint(1, 40))] for _ in range(25)]
    texts += [passage * 40 + [word()] for _ in range(5)]
    texts += [["a"], ["a", "b"], ["a", "b", "c"], ["a", "b", "c", "d"], []]
    return texts


def test_components_equal_all_pairs(spark):
    draw = random.Random(8)
    rows = [(k, " ".join(words)) for k, words in enumerate(groups(draw))]
    rows += [(len(rows) + k, text.upper() + "\n") for k, (_, text) in enumerate(rows[::7])]
    rows += [(10_000, None), (10_001, " \t ")]
    draw.shuffle(rows)
    check(spark, rows)


def test_another_width_and_limit(spark):
    draw = random.Random(9)
    check(spark, [(k, " ".join(words)) for k, words in enumerate(groups(draw)[:120])], NgramJoin(width=2, percent=80))


def test_awkward_rows_and_empty_table(spark, awkward, nothing):
    found = ngram_components(awkward).collect()
    assert len(found) == awkward.count()
    plain = {r["doc_id"]: r["text"] for r in awkward.filter("doc_id is not null").collect()}
    want = exact_components(sorted(plain.items()))
    for row in found:
        if row["doc_id"] is not None:
            assert (row["n_shingles"], row["component_id"]) == want[row["doc_id"]]
    assert ngram_components(nothing).collect() == []


def test_linked_sets_share_a_part():
    draw = np.random.default_rng(4)
    hashes = lambda n: draw.integers(0, 1 << 63, n).astype(np.uint64)
    for size in [9, 10, 11, 12, 19, 20, 57, 300, 2500, 9000]:
        for _ in range(30):
            kept = hashes(size)
            most = differences(size, 90)
            more = draw.integers(0, most + 1)
            left, right = kept, np.concatenate([kept[more // 2 :], hashes(more - more // 2)])
            same = size - more // 2
            if 100 * same >= 90 * (len(left) + len(right) - same):
                assert np.intersect1d(parts(np.sort(left), 90), parts(np.sort(right), 90)).size


def test_size_classes_hold_linked_sizes():
    for percent in (75, 90):
        for small in range(1, 4000):
            assert size_class(small * 100 // percent, percent) - size_class(small, percent) in (0, 1)


def test_divide_skip_equals_plain_overlap():
    draw = np.random.default_rng(5)
    base = draw.integers(0, 1 << 62, 220).astype(np.uint64)
    sets = []
    for _ in range(120):
        kept = draw.permutation(base)[: draw.integers(150, 220)]
        sets.append(np.unique(np.concatenate([kept, draw.integers(0, 1 << 62, draw.integers(0, 20)).astype(np.uint64)])))
    member = np.arange(0, 120, 2)
    for percent in (60, 75, 90):
        for skip in (0.0, 0.0085, 5.0):
            lookup = divide_skip(percent, skip)(sets, member)
            for asked in range(120):
                same = [len(np.intersect1d(sets[asked], sets[k])) for k in member]
                want = [
                    int(k) for k, c in zip(member, same)
                    if 100 * c >= percent * (len(sets[asked]) + len(sets[k]) - c)
                ]
                assert lookup(asked).tolist() == want
