"""Word windows against a search by plain slicing."""

from __future__ import annotations

import random
import re

import pytest

from turnmill.llm.decontaminate import Scanner, scan_documents, spans_in_text

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def by_slices(text, items, window):
    words = WORD.findall((text or "").translate(FOLD))
    hit, names = set(), set()
    for item, content in items:
        own = WORD.findall((content or "").translate(FOLD))
        if item is None or not own:
            continue
        size = min(window, len(own))
        windows = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)}
        for k in range(len(words) - size + 1):
            if tuple(words[k : k + size]) in windows:
                hit.update(range(k, k + size))
                names.add(str(item))
    return len(words), len(hit), sorted(names)


def cases():
    draw = random.Random(5)
    vocabulary = [f"w{k}" for k in range(12)] + ["Ünï", "été"]
    text = lambda n: " ".join(draw.choices(vocabulary, k=n))
    items = [(k, text(draw.randint(1, 30))) for k in range(1, 15)]
    items += [(3, text(20)), (20, items[0][1]), (None, text(15)), (21, None), (22, "--"), (10, items[2][1])]
    texts = [None, "", "!!"] + [text(draw.randint(1, 200)) for _ in range(40)]
    texts += [f"Zz, {items[4][1].upper()}; {text(9)}", items[5][1]]
    return texts, items


@pytest.mark.parametrize("max_bytes", [60, 10**6])
def test_against_slices(spark, max_bytes):
    texts, items = cases()
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id int, text string, scan string")
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id int, text string, scan int")
    found = scan_documents(docs, bench, window=5, max_bytes=max_bytes, into="found").collect()
    assert len(found) == len(texts)
    for row in found:
        n, hit, names = by_slices(texts[row["doc_id"]], items, 5)
        got = row["found"]
        assert (got["n_words"], got["n_hit"], got["items"]) == (n, hit, names)
        assert got["contaminated"] == (hit > 0 and 20 * hit >= n)
        assert row["scan"] == "x"


def test_spans_point_into_the_original():
    text = "Oh -- One,TWO\tthree; four  été five!"
    scanner = Scanner([("7", "two three four"), ("8", "Été")], 13)
    n, firsts, lasts, items = scanner.scan(text)
    assert (n, items) == (7, ["7"])
    assert [text[a:b] for a, b in spans_in_text(text, firsts, lasts)] == ["TWO\tthree; four"]


def test_awkward_rows_and_empty_tables(spark, awkward, nothing):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    assert not any(r["scan"]["contaminated"] for r in scan_documents(awkward, none).collect())
    hit = [r for r in scan_documents(awkward, some).collect() if r["scan"]["contaminated"]]
    assert [r["text"] for r in hit] == ["one two three"]
    assert scan_documents(nothing, some).collect() == []
    assert scan_documents(awkward, some).columns == [*awkward.columns, "scan"]
