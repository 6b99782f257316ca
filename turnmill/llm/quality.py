"""Quality by positive-unlabelled learning with a non-negative risk.

Trusted positives are labelled rows of good quality; everything else that is learnt from is
unlabelled web text, whose labels are not looked at. A class prior, which is estimated from the two, turns them
into an unbiased estimate of the classification risk; where the estimated risk of the negatives goes below zero, the
step goes back, so that a flexible model cannot run away. The model adds up one weight
per bin of each text statistic. Bin edges and the unlabelled part of the risk are over all rows: statistics are
stored once, and every step adds up its sums over them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnmill.llm.common import hash_share, one_label
from turnmill.session import materialize

# Kinds of bytes: 0 lower case, 1 upper case, 2 digit, 3 space, 4 line break, 5 stop and comma,
# 6 other punctuation, 7 sign, 8 control, 9 not ASCII.
_KINDS = np.array(
    [
        9 if c >= 128
        else 0 if "a" <= chr(c) <= "z"
        else 1 if "A" <= chr(c) <= "Z"
        else 2 if "0" <= chr(c) <= "9"
        else 3 if c == 32
        else 4 if c in (10, 13)
        else 5 if chr(c) in ".,"
        else 6 if chr(c) in "!?;:'\"()-"
        else 7 if c > 32 and c != 127
        else 8
        for c in range(256)
    ],
    np.uint8,
)
STATISTICS = 24
CHUNK = 4_096  # rows whose curvature is added up at once
SLOTS = 16


@dataclass(frozen=True)
class Pu:
    positives: int = 8_000  # labelled rows that are learnt from, in expectation; unlabelled ones are all
    bins: int = 12
    steps: int = 12  # Newton steps at most
    back: int = 5  # halvings of a step at most
    enough: float = 1e-6  # less gain ends the steps
    decay: float = 0.03
    guess: float = 0.1  # class prior of the model that the prior is estimated with
    tail: float = 0.5  # smallest share of the positives that it looks at


def statistics(text: str | None) -> np.ndarray:
    """Shares and means that describe a whole text; all 0 for an empty one."""
    out = np.zeros(STATISTICS)
    if not text:
        return out
    raw = text.encode()
    kinds = np.bincount(_KINDS[np.frombuffer(raw, np.uint8)], minlength=10)
    words = raw.split()
    n, size = max(len(words), 1), len(raw)
    lines = raw.split(b"\n")
    distinct = set(words)
    pairs = set(zip(words, words[1:]))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = max(kinds[0] + kinds[1] + kinds[9], 1)
    out[0] = np.log1p(size)
    out[1:9] = kinds[[0, 1, 2, 3, 4, 5, 6, 7]] / size
    out[9] = (kinds[8] + kinds[9]) / size
    out[10] = kinds[1] / letters
    out[11] = len(distinct) / n
    out[12] = len(distinct) / np.sqrt(n)
    out[13] = len(pairs) / max(n - 1, 1)
    out[14] = lengths.mean() if len(words) else 0
    out[15] = lengths.std() if len(words) else 0
    out[16] = lengths.max() if len(words) else 0
    out[17] = (lengths <= 3).sum() / n
    out[18] = sum(a == b for a, b in zip(words, words[1:])) / n
    out[19] = len(set(lines)) / len(lines)
    out[20] = n / len(lines)
    out[21] = raw.count(b".") / n
    out[22] = sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / n
    out[23] = sum(w[:1].isupper() for w in words) / n
    return out


class Model:
    """A weight per bin and statistic; `None` edges mean that nothing was learnt."""

    def __init__(
        self, edges: list[np.ndarray] | None, weights: np.ndarray, bias: float, prior: float | None = None
    ) -> None:
        self.edges, self.weights, self.bias, self.prior = edges, weights, bias, prior

    def bins(self, stats: np.ndarray) -> np.ndarray:
        return binned(stats, self.edges)

    def probability(self, stats: np.ndarray) -> np.ndarray:
        if self.edges is None:
            return np.full(len(stats), 0.5)
        logit = self.bias + self.weights[np.arange(STATISTICS), self.bins(stats)].sum(axis=1)
        return _sigmoid(logit)


def binned(stats: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, stats[:, k], side="right") for k, e in enumerate(edges)], 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _places(bins: np.ndarray, how: Pu) -> np.ndarray:
    """Rows of places in the weight vector: one per statistic, and the bias behind them."""
    places = np.arange(STATISTICS) * how.bins + bins
    return np.concatenate([places, np.full((len(bins), 1), STATISTICS * how.bins)], axis=1)


def moments(bins: np.ndarray, weights: np.ndarray, how: Pu) -> np.ndarray:
    """Sums over rows: their number, the loss as negatives, its slope and its curvature, flat."""
    wide = len(weights)
    total = np.zeros(2 + wide + wide * wide)
    for start in range(0, len(bins), CHUNK):
        places = _places(bins[start : start + CHUNK], how)
        logit = weights[places].sum(axis=1)
        slope = _sigmoid(logit)
        rows = np.zeros((len(places), wide), np.float32)
        rows[np.arange(len(places))[:, None], places] = 1
        curve = (rows * (slope * (1 - slope)).astype(np.float32)[:, None]).T @ rows
        total[0] += len(places)
        total[1] += np.logaddexp(0, logit).sum()
        total[2 : 2 + wide] += slope @ rows
        total[2 + wide :] += curve.ravel()
    return total


def tails(bins: np.ndarray, weights: np.ndarray, limits: np.ndarray, how: Pu) -> np.ndarray:
    """The number of rows, and how many score at least each of the rising `limits`."""
    logit = np.sort(weights[_places(bins, how)].sum(axis=1))
    return np.concatenate([[len(bins)], len(logit) - np.searchsorted(logit, limits, "left")]).astype(float)


class Risk:
    """The unbiased risk of a weight vector: unlabelled rows through sums over all of them, positives
    through their rows.

    With class prior p the risk is p E+[loss(f)] + N, where N = E[loss(-f)] - p E+[loss(-f)] stands for
    the negatives, whose risk cannot be less than zero. For the logistic loss the sum is E[loss(-f)] - p E+[f].
    """

    def __init__(self, positive: np.ndarray, sums, how: Pu) -> None:
        self.how, self.sums = how, sums
        self.places = _places(positive, how)
        self.wide = STATISTICS * how.bins + 1
        self.mean = np.bincount(self.places.ravel(), minlength=self.wide) / max(len(positive), 1)

    def at(self, weights: np.ndarray, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
        """Risk with decay, N, slope and curvature."""
        how = self.how  # what goes to the tasks holds no table
        total = self.sums(lambda bins: moments(bins, weights, how))
        n, wide = max(total[0], 1), self.wide
        unlabelled = total[1] / n
        scores = weights[self.places].sum(axis=1)
        negative = unlabelled - prior * np.logaddexp(0, scores).mean()
        decay = np.full(wide, self.how.decay)
        risk = unlabelled - prior * scores.mean() + (decay * weights**2).sum() / 2
        slope = total[2 : 2 + wide] / n - prior * self.mean + decay * weights
        curve = total[2 + wide :].reshape(wide, wide) / n + np.diag(decay)
        return risk, negative, slope, curve

    def minimise(self, prior: float) -> np.ndarray:
        """Newton steps; a step that raises the risk, or takes that of the negatives below zero, goes back
        by halves."""
        weights = np.zeros(self.wide)
        weights[-1] = np.log(prior / (1 - prior))
        risk, _, slope, curve = self.at(weights, prior)
        for _ in range(self.how.steps):
            step, gain = np.linalg.solve(curve, slope), None
            for _ in range(self.how.back):
                found, negative, *more = self.at(weights - step, prior)
                if negative >= 0 and found <= risk:
                    gain = risk - found
                    weights, risk, (slope, curve) = weights - step, found, more
                    break
                step = step / 2
            if gain is None or gain < self.how.enough:
                break
        return weights

    def above(self, weights: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """Shares of the unlabelled rows that score at least each of the rising `limits`."""
        how = self.how  # what goes to the tasks holds no table
        total = self.sums(lambda bins: tails(bins, weights, limits, how))
        return total[1:] / max(total[0], 1)

    def centred(self, weights: np.ndarray, prior: float) -> np.ndarray:
        """The weights with the bias at which the prior's share of the unlabelled rows scores above 0."""
        steps = weights[:-1].reshape(STATISTICS, -1)
        low, high = (weights[-1] + f(steps, axis=1).sum() for f in (np.min, np.max))
        for _ in range(3):
            limits = np.linspace(low, high, 100)
            at = int((self.above(weights, limits) >= prior).sum())
            low, high = limits[max(at - 1, 0)], limits[min(at, 99)]
        moved = weights.copy()
        moved[-1] -= (low + high) / 2
        return moved


def estimated_prior(positive: np.ndarray, sums, how: Pu) -> float:
    """The share of positives in the unlabelled text, from both alone.

    A model of half the positives, with a small prior, orders texts by how much denser positives are than the
    unlabelled. Above any score there are at least the positives' share of those above it, so the
    lowest ratio of the two shares bounds the prior, and comes near it where scores leave few negatives
    out. The other half of the positives tells the shares, and halves take turns.
    """
    half = np.arange(len(positive)) % 2 == 0
    shares, ratios = np.linspace(how.tail, 0.95, 10), []
    for own, other in ((half, ~half), (~half, half)) if len(positive) > 1 else ((half, half),):
        risk = Risk(positive[own], sums, how)
        weights = risk.minimise(how.guess)
        scores = np.sort(weights[_places(positive[other], how)].sum(axis=1))
        limits = np.quantile(scores, 1 - shares)[::-1]
        known = (len(scores) - np.searchsorted(scores, limits, "left")) / len(scores)
        ratios.append(risk.above(weights, limits) / known)
    return float(np.clip(np.mean(ratios, axis=0).min(), 0.02, 0.98))


def _model(edges: list[np.ndarray], positive: np.ndarray, sums, how: Pu, prior: float | None) -> Model:
    prior = estimated_prior(positive, sums, how) if prior is None else prior
    risk = Risk(positive, sums, how)
    weights = risk.centred(risk.minimise(prior), prior)
    return Model(edges, weights[:-1].reshape(STATISTICS, -1), float(weights[-1]), prior)


def fit_model(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, how: Pu) -> Model:
    """The model of two tables of statistics; without `prior` it is estimated."""
    if not len(positive) or not len(unlabelled):
        return Model(None, np.zeros(0), 0.0)
    cuts = np.linspace(0, 1, how.bins + 1)[1:-1]
    edges = [np.unique(np.quantile(unlabelled[:, k], cuts)) for k in range(STATISTICS)]
    rows = binned(unlabelled, edges)
    return _model(edges, binned(positive, edges), lambda of: of(rows), how, prior)


def _statistics_udf():
    @F.pandas_udf("array<double>")
    def described(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([statistics(t) for t in texts], dtype=object)

    return described


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, STATISTICS)


def _edges(stats: DataFrame, how: Pu) -> list[np.ndarray]:
    """Quantiles of every statistic over all rows, as far as they differ."""
    cuts = [float(c) for c in np.linspace(0, 1, how.bins + 1)[1:-1]]
    quantiles = [F.percentile_approx(F.col("s")[k], cuts, 2_000).alias(str(k)) for k in range(STATISTICS)]
    return [np.unique(np.array(values)) for values in stats.agg(*quantiles).first()]


def _binned(stats: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array(binned(_rows(batch), edges).astype(np.int8).ravel())
            ends = pa.array(np.arange(batch.num_rows + 1) * STATISTICS, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, made)], ["b"])

    return materialize(stats.select("s").mapInArrow(bins, "b array<tinyint>"), "pu-bins")


def _sums(rows: DataFrame):
    """Sums of a function of binned rows over the whole table: per task, then in `SLOTS` groups, of
    which the driver adds up one vector each."""

    def sums(of) -> np.ndarray:
        def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, slot = None, TaskContext.get().partitionId() % SLOTS
            for batch in batches:
                if batch.num_rows:
                    part = of(_rows(batch).astype(np.int64))
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([total.tobytes()])], ["slot", "v"])

        def together(group: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(v) for v in group["v"])
            return pd.DataFrame({"v": [total.tobytes()]})

        per_task = rows.mapInArrow(of_task, "slot int, v binary")
        found = per_task.groupBy("slot").applyInPandas(together, "v binary").collect()
        return sum(np.frombuffer(row["v"]) for row in found)

    return sums


def fit(
    docs: DataFrame, labels: DataFrame, learn_from: Column, how: Pu, ident: str, text: str, label: str
) -> Model:
    trusted = one_label(labels.filter(learn_from), ident, label).filter(F.col(label) == 1)
    described = _statistics_udf()
    # About `positives` identifiers are broadcast, and as many rows of numbers come back.
    trusted = trusted.filter(hash_share(ident, how.positives, trusted.count()))
    found = (
        docs.select(ident, text)
        .join(F.broadcast(trusted.select(ident)), ident)
        .groupBy(ident)
        .agg(F.min(text).alias("text"))
        .select(described("text").alias("s"))
    )
    positive = np.array([r["s"] for r in found.collect()]).reshape(-1, STATISTICS)
    stats = materialize(docs.filter(learn_from).select(described(F.col(text)).alias("s")), "pu-statistics")
    if not len(positive) or not stats.limit(1).count():
        return Model(None, np.zeros(0), 0.0)
    edges = _edges(stats, how)
    return _model(edges, binned(positive, edges), _sums(_binned(stats, edges)), how, None)


def scorer(spark: SparkSession, model: Model):
    """A UDF from text to probability."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            stats = np.array([statistics(t) for t in texts]).reshape(-1, STATISTICS)
            yield pd.Series(shared.value.probability(stats))

    return score


def quality(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    how: Pu = Pu(),
    ident: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    into: str = "quality",
) -> DataFrame:
    """`docs` with the double column `into`, the probability of good quality.

    Positives are rows of `labels` with label 1, unlabelled text comes from `docs`; both only where
    `learn_from` holds; no other label is looked at. The class prior is estimated from the two
    (`estimated_prior`); its share of the unlabelled text scores 0.5 or more.
    Labels with a null are left out; of several labels of an id the
    largest counts. Every row of `docs` stays with all its columns but one named `into`, which is replaced. A null text counts as empty,
    and an empty text is scored like any other. Without positives every score is 0.5. Only the
    text decides, so repeated rows score alike.
    """
    model = fit(docs, labels, learn_from, how, ident, text, label)
    return docs.withColumn(into, scorer(docs.sparkSession, model)(F.col(text)))
