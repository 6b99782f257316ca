"""Runs against a plain search of every period."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from turnmill.llm.queries import QUERIES
from turnmill.llm.runs import Grammar, Runs, runs_of, word_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=6, periods=4):
    """By every period the stretches where words that far apart are equal."""
    found = {}
    for q in range(1, len(words) // periods + 1):
        start = 0
        for k in range(len(words) - q + 1):
            if k == len(words) - q or words[k] != words[k + q]:
                if k + q - start >= max(least, periods * q):
                    found.setdefault((start, k + q), q)  # the smallest period comes first
                start = k + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def sequences(draw):
    made = [[], [1], [1, 1], [2] * 5, [2] * 6, [3] * 1000, [1, 2] * 300 + [1]]
    for _ in range(300):
        kinds = draw.choice([1, 2, 2, 3, 8])
        words = []
        while len(words) < draw.randint(0, 250):
            unit = [draw.randrange(kinds) for _ in range(draw.randint(1, 9))]
            words += (unit * draw.randint(1, 9))[: draw.randint(1, 60)]
        made.append(words)
        made.append([x for x in words for _ in range(draw.randint(1, 3))])
    unit = [draw.randrange(50) for _ in range(130)]
    made += [unit * 5 + unit[:77] + unit * 4, made[-1], made[20] * 4]
    return made


def test_runs_equal_a_plain_search():
    made = sequences(random.Random(4))
    want = [plain_runs(words) for words in made]
    assert sum(map(len, want)) > 1000
    for how in (Runs(), Runs(rounds=2, at_once=50)):
        got = runs_of([np.array(words, np.int64) for words in made], how)
        assert [[tuple(r) for r in rows.tolist()] for rows in got] == want


def test_a_repeated_passage_is_one_nonterminal():
    draw = random.Random(5)
    passage = [draw.randrange(40) for _ in range(64)]
    texts = [[100 + k] + passage + [200 + k] for k in range(32)]
    ids = np.array(sum(texts, []), np.int64)
    grammar = Grammar(ids, np.repeat(np.arange(32), 66), 48)
    assert (grammar.length >= 64).any()
    assert len(grammar.left) < 64 + 3 * 32
    assert len(grammar.symbols) == 32

    def spell(symbol):
        if symbol < grammar.terminals:
            return [int(symbol)]
        rule = symbol - grammar.terminals
        return spell(grammar.left[rule]) + spell(grammar.right[rule])

    assert sum((spell(s) for s in grammar.symbols), []) == ids.tolist()


def test_a_long_text_of_one_word_and_a_long_period():
    assert runs_of([np.zeros(200_000, np.int64)])[0].tolist() == [[0, 200_000, 1]]
    unit = np.random.default_rng(1).integers(0, 9, 30_000)
    assert [0, 120_000, 30_000] in runs_of([np.tile(unit, 4)])[0].tolist()


def collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def check(found, words):
    runs = plain_runs(words)
    assert [(r["start"], r["length"], r["period"]) for r in found["runs"]] == runs
    assert found["collapsed"] == collapsed(words, runs)
    if runs:
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        assert tuple(found["strongest"]) == best
    else:
        assert found["strongest"] is None


def test_texts_with_awkward_rows_and_empty_table(spark, awkward, nothing):
    noisy = ["a b " * 9 + "  c", "x\x1fy " * 8, "a b " * 7, "1 1 1 1 1 1\n\t2\v2\f2 2 2 2 "]
    frame = spark.createDataFrame([(text,) for text in noisy], "text string")
    rows = frame.union(awkward.select("text")).select("text", word_runs(F.col("text")).alias("r")).collect()
    assert len(rows) == len(noisy) + awkward.count()
    for row in rows:
        check(row["r"], WORD.findall(row["text"] or ""))
    assert nothing.select(word_runs(F.col("text"))).collect() == []


def test_query_equals_brute_force(spark, tmp_path):
    draw, rows = random.Random(6), []
    for ident in [*range(400), None]:
        n = draw.choice([0, 1, 5, 40, 90])
        rows.append((ident, " ".join(draw.choice("ab c dd".split(" ")) for _ in range(n)) if n else draw.choice([None, "", " \n"])))
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for ident, text in rows:
        words, h = WORD.findall(text or ""), zlib.crc32(str("" if ident is None else ident).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        row = got[ident]
        assert row["n_runs"] == len(runs)
        assert row["runs_sha256"] == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert row["collapsed_sha256"] == sha(collapsed(words, runs))
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
        assert (row["start"], row["length"], row["period"]) == best
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
