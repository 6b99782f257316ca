"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are the distinct hashes of its words, word starts, word pairs and
pairs with one word between. The model is fitted on a bounded sample of labelled rows by one task that reads their
features as a stream; per-coordinate rates let rare words move quickly and the L1 term leaves few
weights that are not zero, which are then broadcast. Scoring is one pass over the text, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnmill.llm.common import hash_share, one_label

# Letters a-z and all bytes of other characters make words; the rest separates them.
_BYTES = bytes(
    c if c >= 128 else ord(chr(c).lower()) if chr(c).isalpha() else 32 for c in range(256)
)


STARTS = (4, 5, 6)  # bytes of a word's start, so that inflected forms share a feature


@dataclass(frozen=True)
class Ftrl:
    bits: int = 20  # the hashed space has 2 ** bits weights
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 1.0
    epochs: int = 3
    max_rows: int = 12_000  # labelled rows that are learnt from, in expectation


def hashes(text: str | None, bits: int) -> np.ndarray:
    """Hashes of words, word starts, pairs and pairs over one word, some repeats included."""
    words = text.encode().translate(_BYTES).split() if text else []
    seen = set(words)
    starts = [word[:size] for size in STARTS for word in seen if len(word) > size]
    one = np.fromiter(map(crc32, words), np.uint32, len(words))
    start = np.fromiter(map(crc32, starts), np.uint32, len(starts)) + np.uint32(3)
    near = one[:-1] * np.uint32(0x9E3779B1) + one[1:] + np.uint32(1)
    skip = one[:-2] * np.uint32(0x85EBCA6B) + one[2:] + np.uint32(2)
    mixed = np.concatenate([one, start, near, skip]) * np.uint32(2654435761)
    return mixed >> np.uint32(32 - bits)


class Learner:
    """The FTRL-proximal state; `learn` takes one row at a time."""

    def __init__(self, how: Ftrl) -> None:
        self.how = how
        self.z = np.zeros(1 + (1 << how.bits))  # place 0 is the bias, which has no L1 term
        self.n = np.zeros_like(self.z)

    def weights(self, at: np.ndarray) -> np.ndarray:
        how, z = self.how, self.z[at]
        l1 = np.where(at == 0, 0.0, how.l1)
        scale = (how.beta + np.sqrt(self.n[at])) / how.alpha + how.l2
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / scale)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        before = self.n[at]
        after = before + error * error
        self.z[at] += error - (np.sqrt(after) - np.sqrt(before)) / self.how.alpha * w
        self.n[at] = after


def fit(docs: DataFrame, labels: DataFrame, how: Ftrl, ident: str, text: str, label: str):
    """Places and weights that are not zero, or None if there is no labelled row."""
    known = one_label(labels, ident, label)
    chosen = known.filter(hash_share(ident, how.max_rows, known.count()))
    # At most about `max_rows` pairs of numbers are broadcast. Equal ids share a label, so of
    # several texts under one id one is learnt from.
    rows = (
        docs.select(ident, text)
        .join(F.broadcast(chosen), ident)
        .groupBy(ident, label)
        .agg(F.min(text).alias("text"))
    )
    bits = how.bits

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places = [np.unique(hashes(t, bits)).astype(np.int32) + 1 for t in batch["text"]]
            yield pd.DataFrame({"o": batch["o"], "y": batch[label], "at": places})

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = [(np.append(0, at), y) for b in batches for at, y in zip(b["at"], b["y"])]
        if not seen:
            return
        learner = Learner(how)
        for _ in range(how.epochs):
            for at, y in seen:
                learner.learn(at, y)
        at = np.flatnonzero((np.abs(learner.z) > how.l1) | (np.arange(len(learner.z)) == 0))
        yield pd.DataFrame({"at": at, "w": learner.weights(at)})

    order = F.xxhash64(F.col(ident).cast("string"))
    found = (
        rows.withColumn("o", order)
        .select("o", label, "text")
        .mapInPandas(featurise, f"o bigint, y int, at array<int>")
        .repartition(1)
        .sortWithinPartitions("o")
        .mapInPandas(learn, "at bigint, w double")
        .toPandas()
    )
    return None if found.empty else (found["at"].to_numpy(), found["w"].to_numpy())


def scorer(spark: SparkSession, model, how: Ftrl):
    """A UDF from text to probability."""
    shared = spark.sparkContext.broadcast(model)
    bits = how.bits

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dense = np.zeros(1 + (1 << bits), np.float32)
        if shared.value is not None:
            dense[shared.value[0]] = shared.value[1]
        for texts in batches:
            logits = np.empty(len(texts))
            for row, text in enumerate(texts):
                at = hashes(text, bits).astype(np.int64) + 1
                at = np.unique(at[dense[at] != 0])
                logits[row] = dense[0] + dense[at].astype(float).sum()
            made = 1.0 / (1.0 + np.exp(-np.clip(logits, -35, 35)))
            yield pd.Series(made if shared.value is not None else np.zeros(len(texts)))

    return score


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    how: Ftrl = Ftrl(),
    ident: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    into: str = "toxicity",
) -> DataFrame:
    """`docs` with the double column `into`, the probability that `label` is 1.

    Only rows of `labels` that fulfil `learn_from` are learnt from. Every row of `docs` stays with
    all its columns but one named `into`, which is replaced; a null text counts as empty, and an empty text gets the score of the bias.
    Labels with a null are left out, of several labels of an id the largest counts. Without any
    labelled row every score is 0. Only the text decides a score, so repeated rows score alike.
    """
    model = fit(docs, labels.filter(learn_from), how, ident, text, label)
    return docs.withColumn(into, scorer(docs.sparkSession, model, how)(F.col(text)))
