"""Language-model scores by prediction by partial matching over bytes.

A trie of byte contexts is counted over all training texts: for every context of up to `order`
bytes how often each symbol follows (256 bytes and an end of text). In the longest contexts these
are occurrences; a shorter one counts the different longer contexts in which the symbol follows
(single counting). A symbol is predicted in the longest context; one that was never seen there
escapes to the context without its oldest byte, with half a count for each different symbol (method
D), and symbols the longer context had are excluded there. What is excluded from a context depends
on the longer context alone, so every escape and every denominator is computed once.

No task holds the whole trie, and its order is the same at every size. Codes (a context and its symbol) of all
texts are dealt by the last symbols of their contexts; with them come all longer contexts they escape
from, so a task builds that part of the trie and prices its codes. Only the levels above, of at most
two bytes of context, are needed everywhere. Texts look up frequent codes in a broadcast table; their
other codes are joined with the stored prices.

Beside it stands a word unigram model over the same training texts as a baseline.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnmill.llm.common import free_name
from turnmill.session import materialize

SYMBOLS = 257  # bytes are 1 to 256, 0 is the end of a text and what comes before its start
WIDTH = np.uint64(9)
HELD_OUT = np.uint64(1 << 63)  # marks codes of texts that are not learnt from
SHARED = 3  # symbols at the end of a context that keep codes together in one task
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


@dataclass(frozen=True)
class Ppm:
    order: int = 6  # longest context, and the most that codes have room for
    max_pairs: int = 1 << 21  # of context and symbol whose scores are broadcast; the others are joined
    share: int = 1 << 18  # pairs, about, that one task scores
    block: int = 1 << 19  # symbols worked on at once
    flush: int = 2_000_000  # different pairs or words a counting task holds
    alpha: float = 0.1  # added to word counts
    frequent: int = 1 << 17  # words whose counts are broadcast; the others are joined


def _mask(symbols: int) -> np.uint64:
    return np.uint64((1 << (9 * symbols)) - 1)


def blocks(texts, order: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of `order` + 1 successive symbols and the number of the text each belongs to, for
    every byte and the end of each text; a text of any length comes in blocks."""
    parts, owners, held = [], [], 0
    for number, text in enumerate(texts):
        symbols = np.zeros(0, np.uint16)
        if text:
            symbols = np.frombuffer(text.encode(), np.uint8).astype(np.uint16) + np.uint16(1)
        symbols = np.concatenate([np.zeros(order, np.uint16), symbols, np.zeros(1, np.uint16)])
        for start in range(0, len(symbols) - order, size):
            part = symbols[start : start + size + order]
            owner = np.full(len(part), number, np.int32)
            owner[:order] = -1
            parts.append(part)
            owners.append(owner)
            held += len(part)
            if held >= size:
                yield _codes(parts, owners, order)
                parts, owners, held = [], [], 0
    if parts:
        yield _codes(parts, owners, order)


def _codes(parts, owners, order: int) -> tuple[np.ndarray, np.ndarray]:
    x, owner = np.concatenate(parts).astype(np.uint64), np.concatenate(owners)[order:]
    n = len(x) - order
    code = np.zeros(n, np.uint64)
    for k in range(order + 1):
        code = (code << WIDTH) | x[k : k + n]
    real = owner >= 0
    return code[real], owner[real]


class Lookup:
    """An open-addressing hash table from codes to their places in a sorted array."""

    def __init__(self, keys: np.ndarray) -> None:
        bits = max(4, int(np.ceil(np.log2(max(len(keys), 1)))) + 1)
        self.keys, self.shift = keys, np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        self.last = np.int64((1 << bits) - 1)
        left, at = np.arange(len(keys), dtype=np.int32), self._home(keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            placed = self.slots[at] == left
            left, at = left[~placed], (at[~placed] + 1) & self.last

    def _home(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """The place of each code, or -1."""
        if not len(self.keys):
            return np.full(len(codes), -1, np.int32)
        at = self._home(codes)
        found = self.slots[at]
        left = np.flatnonzero((self.keys[found] != codes) & (found >= 0))
        found[left] = -1
        at = at[left]
        while len(left):
            at = (at + 1) & self.last
            place = self.slots[at]
            same = (place >= 0) & (self.keys[place] == codes[left])
            found[left[same]] = place[same]
            on = (place >= 0) & ~same
            left, at = left[on], at[on]
        return found


def levels(order: int, codes: np.ndarray, counts: np.ndarray, least: int = 0) -> dict[int, tuple]:
    """Sorted codes and counts of contexts of `order` symbols and of shorter ones down to `least`."""
    sort = np.argsort(codes)
    level_codes, level_counts = codes[sort], counts[sort].astype(float)
    pairs = {order: (level_codes, level_counts)}
    for k in range(order - 1, least - 1, -1):
        level_codes, inverse = np.unique(level_codes & _mask(k + 1), return_inverse=True)
        level_counts = np.bincount(inverse, minlength=len(level_codes)).astype(float)
        pairs[k] = (level_codes, level_counts)
    return pairs


class Trie:
    """Log10 probabilities of a counted trie; built from the pairs of the longest contexts.

    With `lower`, the levels of the shortest contexts over all texts, the pairs may be a part of
    the trie: all those whose contexts end in the same `len(lower)` symbols.
    """

    def __init__(
        self, order: int, codes: np.ndarray, counts: np.ndarray, lower: dict[int, tuple] | None = None
    ) -> None:
        self.order = order
        lower = lower or {}
        pairs = levels(order, codes, counts, len(lower)) | lower
        self.pairs, self.log_count, self.direct, self.contexts = {}, {}, {}, {}
        self.den, self.esc, self.parent, self.child_den, self.child_esc = {}, {}, {}, {}, {}
        total, distinct = {}, {}
        # Halves are counted: a symbol seen c times weighs 2c - 1, an escape 1 per symbol.
        pairs = {k: (code, 2 * count - 1) for k, (code, count) in pairs.items()}
        for k, (code, count) in pairs.items():
            context = np.unique(code >> WIDTH)
            of = np.searchsorted(context, code >> WIDTH)
            total[k] = np.bincount(of, count, len(context))
            distinct[k] = np.bincount(of, minlength=len(context)).astype(float)
            self.pairs[k], self.contexts[k] = Lookup(code), Lookup(context)
            self.log_count[k] = np.log10(count).astype(np.float32)
            self.den[k] = np.log10(total[k] + distinct[k])
            self.esc[k] = np.log10(distinct[k]) - self.den[k]
            self.direct[k] = (self.log_count[k] - self.den[k][of]).astype(np.float32)
        for k in range(1, order + 1):
            code = pairs[k][0]
            context = self.contexts[k].keys
            of = np.searchsorted(context, code >> WIDTH)
            below = pairs[k - 1][1][np.searchsorted(pairs[k - 1][0], code & _mask(k))]
            excluded = np.bincount(of, below, len(context))
            parent = np.searchsorted(self.contexts[k - 1].keys, context & _mask(k - 1))
            left = distinct[k - 1][parent] - distinct[k]
            den = np.where(left > 0, total[k - 1][parent] - excluded + left, 1.0)
            self.parent[k] = parent.astype(np.int32)
            self.child_den[k] = np.log10(den)
            # Without other symbols in the shorter context it is passed at no cost.
            self.child_esc[k] = np.where(left > 0, np.log10(np.maximum(left, 1)), 0) - np.log10(den)
        seen = distinct[0][0] if len(distinct[0]) else 0
        self.uniform = -np.log10(max(SYMBOLS - seen, 1))

    def score(self, codes: np.ndarray) -> np.ndarray:
        """Log10 probability of the last symbol of each code after the others."""
        out = np.zeros(len(codes))
        left = np.arange(len(codes))
        child = np.full(len(codes), -1, np.int32)
        for k in range(self.order, -1, -1):
            if not len(left):
                return out
            code = codes[left] & _mask(k + 1)
            deeper = child >= 0
            place = self.pairs[k].find(code)
            hit = place >= 0
            if not deeper.any():
                # Nothing is excluded: a hit needs no look at its context.
                out[left[hit]] += self.direct[k][place[hit]]
                context = np.full(len(left), -1, np.int32)
                context[~hit] = self.contexts[k].find(code[~hit] >> WIDTH)
                known = context >= 0
                out[left[known]] += self.esc[k][context[known]]
            else:
                context = np.empty(len(left), np.int32)
                context[deeper] = self.parent[k + 1][child[deeper]]
                context[~deeper] = self.contexts[k].find(code[~deeper] >> WIDTH)
                for those, den, esc, by in (
                    (deeper, self.child_den.get(k + 1), self.child_esc.get(k + 1), child),
                    (~deeper, self.den[k], self.esc[k], context),
                ):
                    now = hit & those
                    out[left[now]] += self.log_count[k][place[now]] - den[by[now]]
                    on = ~hit & those & (context >= 0)
                    out[left[on]] += esc[by[on]]
            left, child = left[~hit], context[~hit]
        out[left] += self.uniform
        return out

    def score_texts(self, texts, size: int) -> np.ndarray:
        total = np.zeros(len(texts))
        for code, owner in blocks(texts, self.order, size):
            total += np.bincount(owner, self.score(code), len(texts))
        return total


class Frequent:
    """What is sent to the tasks: scores of frequent codes, counts of frequent words. A worker builds
    the lookup once."""

    def __init__(self, codes: np.ndarray, scores: np.ndarray) -> None:
        self.codes, self.scores = codes, scores
        self.words: dict[bytes, int] = {}
        self.built: Lookup | None = None

    def lookup(self) -> Lookup:
        if self.built is None:
            self.built = Lookup(self.codes)
        return self.built

    def score_texts(self, texts, how: Ppm) -> tuple[np.ndarray, list[np.ndarray]]:
        """Sums over the frequent codes of each text, and its other codes."""
        total = np.zeros(len(texts))
        codes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
        for code, owner in blocks(texts, how.order, how.block):
            place = self.lookup().find(code)
            hit = place >= 0
            total += np.bincount(owner[hit], self.scores[place[hit]], len(texts))
            codes.append(code[~hit])
            owners.append(owner[~hit])
        # Owners ascend.
        ends = np.searchsorted(np.concatenate(owners), np.arange(1, len(texts)))
        return total, np.split(np.concatenate(codes).view(np.int64), ends)


def _merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    code, inverse = np.unique(np.concatenate(codes), return_inverse=True)
    return code, np.bincount(inverse, np.concatenate(counts)).astype(np.int64)


def count_pairs(texts: DataFrame, how: Ppm) -> DataFrame:
    """`code, n, c`: contexts of `order` symbols with the next one; n over the rows of `text, learnt`
    that are learnt, c over all."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, counts = [], []
        for batch in batches:
            mark = np.where(batch["learnt"].to_numpy(bool), np.uint64(0), HELD_OUT)
            for code, owner in blocks(batch["text"], how.order, how.block):
                code, n = np.unique(code | mark[owner], return_counts=True)
                codes.append(code)
                counts.append(n)
                if sum(map(len, codes)) > how.flush:
                    one, n = _merged(codes, counts)
                    codes, counts = [one], [n]
                    if len(one) > how.flush // 2:
                        yield pd.DataFrame({"code": one.view(np.int64), "n": n})
                        codes, counts = [], []
        if codes:
            one, n = _merged(codes, counts)
            yield pd.DataFrame({"code": one.view(np.int64), "n": n})

    pairs = texts.select("text", "learnt").mapInPandas(count, "code bigint, n bigint")
    learnt = F.when(F.col("code") >= 0, F.col("n")).otherwise(0)
    return pairs.groupBy(_tail(how.order + 1).alias("code")).agg(F.sum(learnt).alias("n"), F.sum("n").alias("c"))


def _tail(symbols: int) -> Column:
    return F.col("code").bitwiseAND(F.lit(int(_mask(symbols))))


def score_codes(texts: DataFrame, how: Ppm) -> DataFrame:
    """`code, c, score` of every code in `texts` (`text, learnt`): how often it occurs, and the log10
    probability of its last symbol after the others in the trie of the learnt rows."""
    spark = texts.sparkSession
    pairs = materialize(count_pairs(texts, how), "ppm-pairs")
    shared = min(SHARED, how.order)
    longer = pairs.filter("n > 0").select(_tail(shared + 1).alias("code")).distinct()
    # Contexts of two bytes and their symbols: at most 257 ** 3 whatever the texts.
    top = longer.groupBy(_tail(shared).alias("code")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    codes, counts = (top.column(name).to_numpy() for name in ("code", "n"))
    lower = spark.sparkContext.broadcast(levels(shared - 1, codes.view(np.uint64), counts))
    order = how.order

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches, schema)
        code, n, c = (held.column(name).to_numpy() for name in ("code", "n", "c"))
        if not len(code):
            return
        code, known = code.view(np.uint64), n > 0
        trie = Trie(order, code[known], n[known], lower.value)
        for start in range(0, len(code), 1 << 16):
            part = slice(start, start + (1 << 16))
            columns = [code[part].view(np.int64), c[part], trie.score(code[part])]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["code", "c", "score"])

    schema = pa.schema([(name, pa.int64()) for name in ("code", "n", "c")])
    parts = max(1, -(-pairs.count() // how.share))
    context = F.shiftright("code", int(WIDTH)).bitwiseAND(F.lit(int(_mask(shared))))
    dealt = pairs.select("code", "n", "c").repartition(parts, context)
    return materialize(dealt.mapInArrow(score, "code bigint, c bigint, score double"), "ppm-scores")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(LOWER).split() if text else []


def count_words(texts: DataFrame, how: Ppm) -> DataFrame:
    """`word, c` over all texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch["text"]:
                held.update(words_of(text))
                if len(held) > how.flush:
                    yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                    held.clear()
        if held:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    words = texts.select("text").mapInPandas(count, "word binary, n bigint")
    return words.groupBy("word").agg(F.sum("n").alias("c"))


def _frequent(counts: DataFrame, limit: int) -> int:
    """The smallest power of two that at most `limit` rows reach in `c`."""
    size = F.floor(F.log2("c")).cast("int")
    sizes = dict(counts.groupBy(size.alias("s")).count().collect())
    least, n = 63, 0
    while least > 0 and n + sizes.get(least - 1, 0) <= limit:
        least -= 1
        n += sizes.get(least, 0)
    return 1 << least


def _score_udf(spark: SparkSession, frequent: Frequent, log_of, how: Ppm):
    shared = spark.sparkContext.broadcast(frequent)
    kind = (
        "n_tokens bigint, n_known bigint, base double, score double, rare array<binary>, times array<int>, "
        "codes array<bigint>"
    )

    @F.pandas_udf(kind)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counts = shared.value.words
        for texts in batches:
            rows = []
            for text in texts:
                seen = Counter(words_of(text))
                n = n_known = 0
                base, rare, times = 0.0, [], []
                for word, often in seen.items():
                    n += often
                    c = counts.get(word)
                    if c is None:
                        rare.append(word)
                        times.append(often)
                    else:
                        n_known += often
                        base += often * log_of(c)
                rows.append((n, n_known, base, rare, times))
            frame = pd.DataFrame(rows, columns=["n_tokens", "n_known", "base", "rare", "times"])
            score, codes = shared.value.score_texts(texts, how)
            frame.insert(3, "score", score)
            yield frame.assign(codes=pd.Series(codes[: len(texts)], dtype=object))

    return score


def score_documents(
    docs: DataFrame,
    learn_from: Column,
    how: Ppm = Ppm(),
    text: str = "text",
    prefix: str = "",
) -> DataFrame:
    """`docs` without its text, with `n_tokens, n_known, train_tokens, base_score, score` (names
    begin with `prefix`; columns of these names are replaced).

    The trie and the word counts are of all rows that fulfil `learn_from`. `score` is the log10
    probability of the text's bytes and its end. Tokens are lower-cased (A-Z) words and one end.
    Every row stays. A null text counts as empty: one token. Repeated rows count
    as often as they occur. Without training rows all symbols are equally likely and `base_score`
    is 0. The end of a text and the place before its first byte are one symbol in contexts.
    """
    spark = docs.sparkSession
    names = [prefix + n for n in ("n_tokens", "n_known", "train_tokens", "base_score", "score")]
    plain = F.coalesce(F.col(text), F.lit("")).alias("text")
    learnt = docs.filter(learn_from).select(plain)
    codes = score_codes(docs.select(plain, F.coalesce(learn_from, F.lit(False)).alias("learnt")), how)
    often = _frequent(codes, how.max_pairs)
    found = codes.filter(F.col("c") >= often).toArrow()
    frequent = Frequent(found.column("code").to_numpy().view(np.uint64), found.column("score").to_numpy())
    counts = materialize(count_words(learnt, how), "ppm-words")
    n_words, n_distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n_ends = learnt.count()
    total = n_words + n_ends
    vocabulary = n_distinct + (n_ends > 0)
    alpha, floor = how.alpha, np.log10(total + how.alpha * (vocabulary + 1))
    log_of = lambda c: float(np.log10(c + alpha) - floor)
    least = _frequent(counts, how.frequent)
    words = counts.filter(F.col("c") >= least).toArrow()
    frequent.words = dict(zip(words.column("word").to_pylist(), words.column("c").to_pylist()))
    # A text's rare words are joined with their counts; frequent ones never reach a shuffle.
    row = free_name(docs, "_row")
    made, key = free_name(docs, "_made"), free_name(docs, "_row_key")
    known, part, sum_of = (free_name(docs, name) for name in ("_known", "_part", "_sum"))
    code_key = free_name(docs, "_code_key")
    kept = [c for c in docs.columns if c != text and c not in names]
    scored = materialize(
        docs.withColumn(row, F.monotonically_increasing_id())
        .withColumn(made, _score_udf(spark, frequent, log_of, how)(F.col(text)))
        .select(row, *kept, made),
        "ppm-scored",
    )
    pairs = scored.select(
        F.col(row).alias(key), F.explode(F.arrays_zip(f"{made}.rare", f"{made}.times")).alias("p")
    ).select(key, F.col("p.rare").alias("word"), F.col("p.times").alias("times"))
    c = F.coalesce("c", F.lit(0))
    rare = (
        pairs.join(counts.filter(F.col("c") < least), "word", "left")
        .groupBy(key)
        .agg(
            F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias(known),
            F.sum(F.col("times") * (F.log10(c + alpha) - F.lit(float(floor)))).alias(part),
        )
    )
    # So are its rare codes; none occurs often enough to be a hot key.
    rest = (
        scored.select(F.col(row).alias(code_key), F.explode(F.col(made)["codes"]).alias("code"))
        .join(codes.filter(F.col("c") < often).select("code", "score"), "code")
        .groupBy(code_key)
        .agg(F.sum("score").alias(sum_of))
    )
    end = log_of(n_ends)
    values = (
        F.col(made)["n_tokens"] + 1,
        F.col(made)["n_known"] + F.coalesce(known, F.lit(0)) + int(n_ends > 0),
        F.lit(total).cast("bigint"),
        F.col(made)["base"] + F.coalesce(part, F.lit(0.0)) + end,
        F.col(made)["score"] + F.coalesce(sum_of, F.lit(0.0)),
    )
    joined = scored.join(rare, F.col(row) == F.col(key), "left")
    return joined.join(rest, F.col(row) == F.col(code_key), "left").select(
        *kept, *[value.alias(name) for value, name in zip(values, names)]
    )
