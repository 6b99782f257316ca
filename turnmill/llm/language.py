"""Language identification by error-correcting output codes.

Every language gets a codeword; for each of its bits a binary classifier over hashed byte n-grams
tells the languages that have the bit set from those that have it clear. The classifiers are
log-odds of n-gram shares, so one pass that counts n-grams per language over all training rows
fits them all. A document goes to the codeword with the smallest loss, in which a bit weighs as
much as its classifier separates the two sides; a close second marks it as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UNDETERMINED = "und"
MAX_LANGUAGES = 512  # bounds the model: 512 languages are 120 bits of 2 ** 15 weights, 16 MB
RESULT = "lang_pred string, score double, ambiguous boolean, second string"

_IS_LETTER = np.array([c >= 128 or chr(c).isalpha() for c in range(256)])


@dataclass(frozen=True)
class Ecoc:
    bits: int = 15  # n-grams are hashed to 2 ** bits places
    smoothing: float = 0.5
    grams: int = 400  # evidence of a text stops growing at about so many n-grams
    margin: float = 0.2  # ambiguous if the best two probabilities are closer


def places(text: str, bits: int) -> np.ndarray:
    """Hashed 2-, 3- and 4-grams of the letters' bytes, runs of anything else as one space."""
    raw = np.frombuffer(f" {text.lower()} ".encode(), np.uint8)
    x = np.where(_IS_LETTER[raw], raw, np.uint8(32))
    x = x[np.append(True, (x[1:] != 32) | (x[:-1] != 32))].astype(np.uint32)
    x = np.pad(x, 1, constant_values=32)  # a single letter has n-grams too
    four = x[:-3] | x[1:-2] << 8 | x[2:-1] << 16 | x[3:] << 24
    mix, shift = np.uint32(2654435761), np.uint32(32 - bits)
    three = (four & np.uint32(0xFFFFFF)) + np.uint32(0x51000000)
    two = (four & np.uint32(0xFFFF)) + np.uint32(0x52000000)
    return (np.concatenate([four, three, two]) * mix) >> shift


def codewords(languages: int) -> np.ndarray:
    """One row of +1/-1 per language. All splits of the languages if they are few, else columns
    drawn by a fixed seed, half of the languages set in each."""
    if languages <= 1:
        return np.ones((languages, 1))
    if languages <= 6:
        columns = 2 ** (languages - 1) - 1
        code = np.empty((languages, columns))
        for column in range(columns):
            # Language 0 is always set, so that no split appears with its mirror image.
            code[0, column] = 1
            code[1:, column] = [1 if column >> k & 1 else -1 for k in range(languages - 1)]
        return code
    wide = int(np.ceil(12 * np.log2(languages)))
    draw = np.random.default_rng(7)
    half = np.where(np.arange(languages) % 2 == 0, 1.0, -1.0)
    return np.stack([draw.permutation(half) for _ in range(wide)], axis=1)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # language x bit
    weights: np.ndarray  # place x bit
    trust: np.ndarray  # weight of a bit's loss
    how: Ecoc

    def predict(self, text: str | None) -> tuple[str, float, bool, str | None]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, False, None
        at = places(text, self.how.bits)
        if len(at) > len(self.weights):
            total = np.bincount(at, minlength=len(self.weights)) @ self.weights
        else:
            total = self.weights[at].sum(axis=0, dtype=float)
        evidence = total / len(at) * min(len(at), self.how.grams)
        loss = np.logaddexp(0, -self.code * evidence) @ self.trust
        likely = np.exp(loss.min() - loss)
        likely /= likely.sum()
        order = np.lexsort((np.arange(len(likely)), -likely))
        first, score = self.languages[order[0]], float(likely[order[0]])
        if len(order) == 1:
            return first, score, False, None
        second = order[1]
        close = bool(score - likely[second] < self.how.margin)
        return first, score, close, self.languages[second]


def fit(rows: DataFrame, how: Ecoc, text: str, lang: str) -> Model:
    """Count n-grams per language over all `rows` and derive every bit's classifier."""
    bits = how.bits

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, content in zip(batch["lang"], batch["text"]):
                held = sums.setdefault(language, np.zeros(1 << bits, np.int64))
                np.add(held, np.bincount(places(content, bits), minlength=len(held)), out=held)
        for language, held in sums.items():
            at = np.flatnonzero(held)
            yield pd.DataFrame({"lang": language, "at": at, "n": held[at]})

    known = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counted = (
        known.filter("lang is not null and text is not null")
        .mapInPandas(count, "lang string, at int, n bigint")
        .groupBy("lang", "at")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")  # at most 2 ** bits pairs a language
        .agg(F.collect_list("at").alias("at"), F.collect_list("n").alias("n"))
        .orderBy("lang")
        .limit(MAX_LANGUAGES + 1)
        .collect()
    )
    if len(counted) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    shares = np.full((len(counted), 1 << bits), how.smoothing)
    for number, row in enumerate(counted):
        shares[number, row["at"]] += row["n"]
    shares /= shares.sum(axis=1, keepdims=True)
    code = codewords(len(counted))
    weights = np.zeros((1 << bits, code.shape[1]), np.float32)
    trust = np.ones(code.shape[1])
    for bit in range(code.shape[1] if len(counted) > 1 else 0):
        on = shares[code[:, bit] > 0].mean(axis=0)
        off = shares[code[:, bit] < 0].mean(axis=0)
        weights[:, bit] = np.log(on / off)
        trust[bit] = ((on - off) * np.log(on / off)).sum()  # how far apart the two sides are
    trust /= max(trust.sum(), 1e-9)
    return Model([row["lang"] for row in counted], code, weights, trust, how)


def predictor(spark: SparkSession, model: Model):
    """A UDF from text to `lang_pred, score, ambiguous, second`."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in batches:
            yield pd.DataFrame(
                [own.predict(t) for t in texts],
                columns=["lang_pred", "score", "ambiguous", "second"],
            )

    return predict


def identify(
    docs: DataFrame,
    learn_from: Column,
    how: Ecoc = Ecoc(),
    text: str = "text",
    lang: str = "lang",
    into: str = "language",
) -> DataFrame:
    """`docs` with a struct column `into`: `lang_pred, score, ambiguous, second`.

    Learns from every row that fulfils `learn_from` and has a text and a language; the language
    of no other row is looked at. Every row stays with all its columns but one named `into`, which is
    replaced. A null text, one without a letter (digits, fractions and other signs are none), and every text if nothing could be learnt, is `und` with score 0. With one language learnt it
    gets score 1. Equal losses go to the language that sorts first. Scores depend on the text
    alone, so repeated rows get the same.
    """
    model = fit(docs.filter(learn_from), how, text, lang)
    return docs.withColumn(into, predictor(docs.sparkSession, model)(F.col(text)))
