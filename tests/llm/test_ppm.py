"""The trie against a plain recursion, that probabilities add up, and the word baseline."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnmill.llm.ppm import SYMBOLS, Ppm, Trie, blocks, score_documents

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def symbols(text, order):
    return [0] * order + [b + 1 for b in text.encode()] + [0]


def counted(texts, order):
    """Context -> symbol -> count: occurrences at the top, different longer contexts below."""
    levels = [defaultdict(Counter) for _ in range(order + 1)]
    for text in texts:
        s = symbols(text, order)
        for k in range(order, len(s)):
            levels[order][tuple(s[k - order : k])][s[k]] += 1
    for k in range(order - 1, -1, -1):
        for context, following in levels[k + 1].items():
            for symbol in following:
                levels[k][context[1:]][symbol] += 1
    return levels


def plain(levels, context, symbol):
    p, excluded = 1.0, set()
    for k in range(len(levels) - 1, -1, -1):
        own = {s: 2 * c - 1 for s, c in levels[k].get(context[len(context) - k :], {}).items() if s not in excluded}
        if own:
            total = sum(own.values()) + len(own)
            if symbol in own:
                return p * own[symbol] / total
            p *= len(own) / total
            excluded |= set(own)
    return p / (SYMBOLS - len(excluded))


TEXTS = ["abracadabra", "abra", "", "cadabra été", "bbbbbbb", "abracadabra"]


def trie(texts, order):
    codes = [c for c, _ in blocks(texts, order, 7)]
    code, count = np.unique(np.concatenate(codes) if codes else np.zeros(0, np.uint64), return_counts=True)
    return Trie(order, code, count)


@pytest.mark.parametrize("order", [1, 2, 4, 6])
def test_scores_equal_the_recursion(order):
    levels, made = counted(TEXTS, order), trie(TEXTS, order)
    for text in [*TEXTS, "abrazada", "xyz", "é" * 5, "a"]:
        s = symbols(text, order)
        want = sum(
            math.log10(plain(levels, tuple(s[k - order : k]), s[k])) for k in range(order, len(s))
        )
        assert made.score_texts([text], 5)[0] == pytest.approx(want, rel=1e-5)


def test_probabilities_add_up():
    made, order = trie(TEXTS, 3), 3
    for context in ([0, 0, 0], [98, 99, 115], [200, 1, 2]):
        code = 0
        for symbol in context:
            code = code << 9 | symbol
        every = np.array([code << 9 | s for s in range(SYMBOLS)], np.uint64)
        assert (10 ** made.score(every)).sum() == pytest.approx(1, abs=1e-4)


def baseline(rows, learnt):
    count = Counter()
    tokens = {k: WORD.findall((t or "").translate(FOLD)) + [None] for k, t in enumerate(rows)}
    for k in learnt:
        count.update(tokens[k])
    total, distinct = sum(count.values()), len(count)
    score = lambda k: sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens[k])
    return {k: (len(tokens[k]), sum(count[w] > 0 for w in tokens[k]), total, score(k)) for k in tokens}


@pytest.mark.parametrize("how", [Ppm(frequent=3, order=3), Ppm(flush=40, block=64), Ppm(order=5, max_pairs=400)])
def test_awkward_rows(spark, awkward, how):
    texts = [r["text"] for r in awkward.collect()]
    docs = spark.createDataFrame(
        [(k, t, "?", "?", "?") for k, t in enumerate(texts)],
        "place int, text string, score string, n_tokens string, r string",
    )
    found = score_documents(docs, F.col("place") % 3 != 0, how)
    assert set(found.columns) == {"place", "r", "n_tokens", "n_known", "train_tokens", "base_score", "score"}
    want = baseline(texts, [k for k in range(len(texts)) if k % 3])
    rows = found.collect()
    assert len(rows) == len(texts)
    for row in rows:
        n, known, total, base = want[row["place"]]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (n, known, total)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        assert row["score"] < 0


def test_nothing_to_learn_from_and_empty_table(awkward, nothing):
    row = score_documents(awkward.filter("doc_id = 7"), F.lit(False)).first()
    assert row["base_score"] == 0 and row["n_known"] == 0
    size = len(awkward.filter("doc_id = 7").first()["text"].encode()) + 1
    assert row["score"] == pytest.approx(-size * math.log10(SYMBOLS))
    assert score_documents(nothing, F.lit(True)).collect() == []


@pytest.mark.parametrize("how", [Ppm(max_pairs=30), Ppm(max_pairs=0, share=16), Ppm(order=2, max_pairs=5), Ppm(share=50)])
def test_scores_keep_their_order_whatever_the_number_of_pairs(spark, how):
    """Frequent codes and joined ones add up to the recursion of the full order."""
    texts = [*TEXTS, None, "abrazada", "xyz", "é" * 5, "a", "cadabra bra"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string").repartition(3)
    learnt = range(len(TEXTS) + 1)
    order, levels = how.order, counted([texts[k] or "" for k in learnt], how.order)
    for row in score_documents(docs, F.when(F.col("k") < len(learnt), True), how).collect():
        s = symbols(texts[row["k"]] or "", order)
        want = sum(math.log10(plain(levels, tuple(s[i - order : i]), s[i])) for i in range(order, len(s)))
        assert row["score"] == pytest.approx(want, rel=1e-5)
