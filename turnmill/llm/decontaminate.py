"""Benchmark passages in documents, found by one Aho-Corasick automaton over word windows.

Test questions and answers are lower-cased (A-Z), cut into words, and every run of 13 words becomes
a pattern over word numbers. A document is scanned once; each match gives the place of its last
word, so hits are word ranges, which `spans_in_text` maps to offsets in the original text. Nothing
is shuffled: the automaton goes to the tasks. Its size is bounded: benchmarks of more than
`max_bytes` of text are dealt into blocks with an automaton each, and the ranges are united.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from turnmill.llm.common import free_name

# What is a word and when a document counts as contaminated.
WINDOW = 13
WORD_CHARS = "0123456789abcdefghijklmnopqrstuvwxyz"
MIN_SHARE = 20  # contaminated from one hit word in 20
# End of fixed values.
MAX_BYTES = 2_000_000  # of benchmark text per automaton, some 150 MB in a worker

SCAN = "n_words bigint, firsts array<int>, lasts array<int>, items array<string>"

# Upper case to lower; ASCII that is no letter or digit to a space; bytes of other characters stay.
_BYTES = bytes(
    c if c >= 128 else ord(chr(c).lower()) if chr(c).lower() in WORD_CHARS else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_BYTES).split() if text else []


def windows_of(items: list[tuple[str, str]], window: int) -> dict[tuple[bytes, ...], set[str]]:
    found = defaultdict(set)
    for item, text in items:
        words = words_of(text)
        if not words:
            continue
        for start in range(max(1, len(words) - window + 1)):
            found[tuple(words[start : start + window])].add(item)
    return found


class Scanner:
    """The automaton of one block of items."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        self.number: dict[bytes, int] = {}
        self.patterns: list[tuple[int, set[str]]] = []
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for words, names in windows_of(items, window).items():
            key = tuple(self.number.setdefault(w, len(self.number) + 1) for w in words)
            self.automaton.add_word(key, len(self.patterns))
            self.patterns.append((len(words), names))
        if self.patterns:
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[int], list[int], list[str]]:
        """Number of words, first and last word of each merged range that is hit, items."""
        words = words_of(text)
        if not words or not self.patterns:
            return len(words), [], [], []
        get = self.number.get
        firsts, lasts, hit = [], [], set()
        for last, pattern in self.automaton.iter(tuple(get(w, 0) for w in words)):
            first = last - self.patterns[pattern][0] + 1
            hit.add(pattern)
            while firsts and firsts[-1] >= first:  # a longer window may start earlier
                firsts.pop()
                lasts.pop()
            if lasts and lasts[-1] >= first - 1:
                lasts[-1] = max(lasts[-1], last)
            else:
                firsts.append(first)
                lasts.append(last)
        names = set().union(*(self.patterns[p][1] for p in hit)) if hit else ()
        return len(words), firsts, lasts, sorted(names)


def spans_in_text(text: str, firsts: list[int], lasts: list[int]) -> list[tuple[int, int]]:
    """Word ranges as (start, end) offsets in the original text."""
    folded = text.translate({c: chr(_BYTES[c]) for c in range(128)})
    places, at = [], 0
    for word in folded.split(" "):
        if word:
            places.append((at, at + len(word)))
        at += len(word) + 1
    return [(places[first][0], places[last][1]) for first, last in zip(firsts, lasts)]


def _scan_udf(spark, items: list[tuple[str, str]], window: int):
    shared = spark.sparkContext.broadcast(items)

    @F.pandas_udf(SCAN)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(shared.value, window)
        for texts in batches:
            yield pd.DataFrame(
                [scanner.scan(t) for t in texts], columns=["n_words", "firsts", "lasts", "items"]
            )

    return scan


def _item_blocks(benchmark: DataFrame, item: str, text: str, max_bytes: int):
    """Distinct items, in lists of about `max_bytes` of text."""
    rows = (
        benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
        .filter("item is not null and text is not null")
        .distinct()
    )
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-n_bytes // max_bytes)
    for number in range(blocks):
        mine = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number)
        yield [tuple(row) for row in mine.collect()]


def _covered(firsts: Column, lasts: Column) -> Column:
    """Words inside the union of ranges."""
    ranges = F.array_sort(F.arrays_zip(firsts.alias("f"), lasts.alias("l")))
    start = F.struct(F.lit(-1).alias("upto"), F.lit(0).cast("bigint").alias("n"))
    step = lambda acc, r: F.struct(
        F.greatest(acc["upto"], r["l"]).alias("upto"),
        (
            acc["n"] + F.greatest(F.lit(0), r["l"] - F.greatest(r["f"] - 1, acc["upto"]))
        ).cast("bigint").alias("n"),
    )
    return F.aggregate(ranges, start, step, lambda acc: acc["n"])


def scan_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_bytes: int = MAX_BYTES,
    into: str = "scan",
) -> DataFrame:
    """`docs` with a struct column `into`: `n_words, n_hit, firsts, lasts, items, contaminated`.

    Every row of `docs` stays, with all its columns but one named `into`, which is replaced. A null or empty text has no words and is
    clean. Items with a null id or text, or without words, match nothing; an item of fewer words
    than `window` is one window; rows of one item add up; equal windows of several items count for each.
    `firsts` and `lasts` are word ranges. An empty benchmark leaves every document clean.
    """
    spark = docs.sparkSession
    parts = []
    out = docs
    for items in _item_blocks(benchmark, item, item_text, max_bytes):
        name = free_name(out, f"_scan{len(parts)}")
        out = out.withColumn(name, _scan_udf(spark, items, window)(F.col(text)))
        parts.append(name)
    if not parts:
        name = free_name(out, "_scan0")
        out = out.withColumn(name, _scan_udf(spark, [], window)(F.col(text)))
        parts.append(name)
    gather = lambda field: F.flatten(F.array(*[F.col(p)[field] for p in parts]))
    n_words = F.col(parts[0])["n_words"]
    n_hit = _covered(gather("firsts"), gather("lasts"))
    made = F.struct(
        n_words.alias("n_words"),
        n_hit.alias("n_hit"),
        gather("firsts").alias("firsts"),
        gather("lasts").alias("lasts"),
        F.array_sort(F.array_distinct(gather("items"))).alias("items"),
        ((n_hit > 0) & (n_hit * MIN_SHARE >= n_words)).alias("contaminated"),
    )
    return out.withColumn(into, made).drop(*parts)
