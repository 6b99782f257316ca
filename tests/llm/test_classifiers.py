"""Language, toxicity and quality: held-out accuracy, and defined results for awkward rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnmill.llm import language, quality, toxicity
from turnmill.llm.common import remainder

LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark, small):
    return spark.read.parquet(f"{LARGER}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark, small):
    return spark.read.parquet(f"{LARGER}/labels.parquet")


def test_remainder_is_crc32_of_the_text(spark):
    rows = spark.createDataFrame([(5,), (-17,), (10**12,), (None,)], "doc_id bigint")
    for row in rows.select("doc_id", remainder("doc_id", 7).alias("r")).collect():
        text = "" if row["doc_id"] is None else str(row["doc_id"])
        assert row["r"] == zlib.crc32(text.encode()) % 7


# Language


def test_languages_of_held_out_documents(docs):
    held_out = remainder("doc_id", 4) == 2
    found = language.identify(docs, ~held_out).filter(held_out & (F.col("n_chars") > 30)).collect()
    assert np.mean([r["lang"] == r["language"]["lang_pred"] for r in found]) >= 0.98
    assert all(0 <= r["language"]["score"] <= 1 for r in found)


def test_language_never_reads_labels_of_held_out_rows(docs):
    held_out = remainder("doc_id", 4) == 2
    hidden = docs.withColumn("lang", F.when(held_out, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit(None))
    get = lambda d: {r["doc_id"]: tuple(r["language"]) for r in language.identify(d, ~held_out).collect()}
    assert get(docs) == get(hidden)


@pytest.mark.parametrize("languages", [2, 3, 4, 6, 7, 30])
def test_codewords_differ(languages):
    code = language.codewords(languages)
    distances = [(code[a] != code[b]).sum() for a in range(languages) for b in range(a)]
    assert min(distances) >= (1 if languages < 4 else max(2, code.shape[1] // 4))
    assert all(abs(column.sum()) < languages for column in code.T)  # no bit is constant


def test_one_wrong_bit_is_corrected():
    """With evidence against one bit of the codeword, the nearest codeword still is the right one."""
    code = language.codewords(4)
    for row in range(4):
        for bit in range(code.shape[1]):
            evidence = 3 * code[row].copy()
            evidence[bit] *= -1
            loss = np.logaddexp(0, -code * evidence).sum(axis=1)
            assert loss.argmin() == row


def test_language_of_awkward_rows(awkward, nothing):
    made = language.identify(awkward, F.col("doc_id") % 2 == 0)
    assert made.columns == [*awkward.columns, "language"]
    rows = made.collect()
    assert len(rows) == awkward.count()
    for row in rows:
        found = row["language"]
        if row["text"] is None or not any(map(str.isalpha, row["text"])):
            assert (found["lang_pred"], found["score"]) == ("und", 0.0)
        else:
            assert found["lang_pred"] in ("de", "en") and 0 <= found["score"] <= 1
    assert {r["language"]["lang_pred"] for r in language.identify(awkward, F.lit(False)).collect()} == {"und"}
    assert language.identify(nothing, F.lit(True)).collect() == []
    one = awkward.filter("lang = 'de' or lang is null")
    assert {r["language"]["lang_pred"] for r in language.identify(one, F.lit(True)).collect()} == {"de", "und"}


# Toxicity


def toxic_corpus(spark):
    """Clean and toxic texts; toxic ones hold forms of a word, or a pair of plain words."""
    draw = random.Random(8)
    word = lambda: "".join(draw.choices("abcdefghij", k=draw.randint(2, 4)))
    rows = []
    for ident in range(900):
        words = [word() for _ in range(draw.randint(20, 120))]
        toxic = int(draw.random() < 0.3)
        at = draw.randrange(len(words))
        if toxic and ident % 2:
            words[at] = "zzgrob" + word()
        elif toxic:
            words[at : at + 1] = ["kalt", "warm"]
        else:
            words[at] = draw.choice(["kalt", "warm"])
        rows.append((ident, " ".join(words), toxic))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").repartition(4)
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")


def test_held_out_toxic_texts_are_found(spark):
    docs, labels = toxic_corpus(spark)
    held_out = remainder("doc_id", 5) == 0
    made = toxicity.toxicity(docs, labels, ~held_out, into="p").filter(held_out).join(labels, "doc_id")
    right = np.mean([(r["p"] >= 0.5) == bool(r["toxic"]) for r in made.collect()])
    assert right >= 0.95


def test_weights_are_few(spark):
    docs, labels = toxic_corpus(spark)
    at, weights = toxicity.fit(docs, labels, toxicity.Ftrl(), "doc_id", "text", "toxic")
    assert len(at) < 3000 and (weights[at > 0] != 0).all()


def test_toxicity_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame(
        [(8, 1), (9, 0), (9, 1), (10, 0), (11, None), (None, 1), (999, 1), (0, 0)], "doc_id bigint, toxic int"
    )
    made = toxicity.toxicity(awkward, labels, F.lit(True), into="p")
    assert made.columns == [*awkward.columns, "p"]
    rows = made.collect()
    assert len(rows) == awkward.count() and all(0 <= r["p"] <= 1 for r in rows)
    empty = {r["p"] for r in rows if not r["text"]}
    assert len(empty) == 1
    by_text = {}
    for row in rows:
        by_text.setdefault(row["text"], set()).add(row["p"])
    assert all(len(p) == 1 for p in by_text.values())
    none = labels.filter("false")
    assert {r["p"] for r in toxicity.toxicity(awkward, none, F.lit(True), into="p").collect()} == {0.0}
    assert toxicity.toxicity(nothing, labels, F.lit(True), into="p").collect() == []


# Quality


def test_quality_of_held_out_documents(docs, labels):
    held_out = remainder("doc_id", 3) == 1
    made = quality.quality(docs, labels, ~held_out, into="p").filter(held_out).join(labels, "doc_id").collect()
    good = [r["p"] for r in made if r["quality"] == 1]
    bad = [r["p"] for r in made if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) >= 0.95
    assert np.mean([(r["p"] >= 0.5) == bool(r["quality"]) for r in made]) >= 0.93


def test_the_non_negative_risk_learns_without_negatives():
    """Two overlapping classes; only positives and a mixture are seen."""
    draw = np.random.default_rng(3)
    make = lambda n, mean: draw.normal(mean, 1, (n, quality.STATISTICS))
    positive, mixture = make(800, 0.8), np.concatenate([make(1200, 0.8), make(800, -0.8)])
    model = quality.fit_model(positive, mixture, 0.6, quality.Pu())
    assert (model.probability(make(500, 0.8)) >= 0.5).mean() >= 0.9
    assert (model.probability(make(500, -0.8)) < 0.5).mean() >= 0.9


def test_the_prior_comes_from_positives_and_unlabelled_rows(docs, labels):
    """Near the share among labelled rows, of which only the positives were seen."""
    free = remainder("doc_id", 3) != 1
    model = quality.fit(docs, labels, free, quality.Pu(), "doc_id", "text", "quality")
    share = labels.filter(free).agg(F.avg("quality")).first()[0]
    assert model.prior == pytest.approx(share, abs=0.08)
    draw = np.random.default_rng(4)
    make = lambda n, mean: draw.normal(mean, 1, (n, quality.STATISTICS))
    for share in (0.2, 0.5, 0.8):
        n = int(3000 * share)
        mixture = np.concatenate([make(n, 0.5), make(3000 - n, -0.5)])
        assert quality.fit_model(make(2000, 0.5), mixture, None, quality.Pu()).prior == pytest.approx(share, abs=0.08)


def test_the_risk_of_a_weight_vector():
    """Sums, slope and curvature of the risk against plain loops and differences."""
    draw, how = np.random.default_rng(5), quality.Pu(bins=3)
    positive, rows = draw.integers(0, 3, (40, quality.STATISTICS)), draw.integers(0, 3, (90, quality.STATISTICS))
    risk = quality.Risk(positive, lambda of: sum(of(part) for part in np.array_split(rows, 4)), how)
    weights, prior = draw.normal(size=risk.wide) / 5, 0.4

    def plain(w):
        score = lambda row: w[-1] + sum(w[3 * k + b] for k, b in enumerate(row))
        as_good = np.mean([np.log1p(np.exp(-score(r))) for r in positive])
        as_bad = np.mean([np.log1p(np.exp(score(r))) for r in positive])
        negative = np.mean([np.log1p(np.exp(score(r))) for r in rows]) - prior * as_bad
        return prior * as_good + negative + how.decay * (w**2).sum() / 2, negative

    value, negative, slope, curve = risk.at(weights, prior)
    assert (value, negative) == pytest.approx(plain(weights), rel=1e-5)
    for k in draw.integers(0, risk.wide, 6):
        move = np.zeros(risk.wide)
        move[k] = 1e-4
        difference = (plain(weights + move)[0] - plain(weights - move)[0]) / 2e-4
        assert slope[k] == pytest.approx(difference, abs=1e-5)
        higher = risk.at(weights + move, prior)[2]
        assert curve[:, k] == pytest.approx((higher - slope) / 1e-4, abs=1e-3)


def test_a_step_goes_back_where_the_risk_of_negatives_is_below_zero():
    """Few positives that are told apart from all unlabelled rows, and a prior that is too high."""
    draw = np.random.default_rng(6)
    positive, mixture = draw.normal(1, 1, (30, quality.STATISTICS)), draw.normal(0, 1, (300, quality.STATISTICS))
    edges = [np.quantile(mixture[:, k], np.linspace(0, 1, 13)[1:-1]) for k in range(quality.STATISTICS)]
    rows = quality.binned(mixture, edges)
    risk = quality.Risk(quality.binned(positive, edges), lambda of: of(rows), quality.Pu(decay=1e-6))
    weights = risk.minimise(0.9)
    assert risk.at(weights, 0.9)[1] >= 0
    free = quality.Risk(risk.places[:, :-1] % 12, lambda of: of(rows), quality.Pu(decay=1e-6, back=1, steps=1))
    start = np.zeros(free.wide)
    start[-1] = np.log(9)
    _, _, slope, curve = free.at(start, 0.9)
    assert free.at(start - np.linalg.solve(curve, slope), 0.9)[1] < 0  # the whole step would go below it


def test_quality_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame(
        [(k, int(k % 3 > 0)) for k in range(5, 30)] + [(7, None), (None, 1), (12, 0)], "doc_id bigint, quality int"
    )
    made = quality.quality(awkward, labels, F.lit(True), into="p")
    assert made.columns == [*awkward.columns, "p"]
    rows = made.collect()
    assert len(rows) == awkward.count() and all(0 <= r["p"] <= 1 for r in rows)
    assert len({r["p"] for r in rows if not r["text"]}) == 1
    none = labels.filter("quality = 0")
    assert {r["p"] for r in quality.quality(awkward, none, F.lit(True), into="p").collect()} == {0.5}
    assert quality.quality(nothing, labels, F.lit(True), into="p").collect() == []


# Names


def test_a_column_of_the_result_name_is_replaced(spark, awkward):
    labels = spark.createDataFrame([(k, k % 2) for k in range(5, 30)], "doc_id bigint, toxic int")
    quality_labels = labels.withColumnRenamed("toxic", "quality")
    for made in (
        toxicity.toxicity(awkward, labels, F.lit(True), into="score"),
        quality.quality(awkward, quality_labels, F.lit(True), into="score"),
        language.identify(awkward, F.lit(True), into="score"),
    ):
        assert sorted(made.columns) == sorted(awkward.columns)
        assert all(row["score"] is not None and row["score"] != "?" for row in made.collect())


def test_signs_without_letters_have_no_language(spark, docs):
    texts = ["½ ² ③", "①②", "x²", "Ⅳ", "１２", "ª", "中"]
    frame = docs.select("text", "lang").limit(200).union(
        spark.createDataFrame([(t, None) for t in texts], "text string, lang string")
    )
    found = language.identify(frame, F.lit(True)).filter(F.col("text").isin(texts)).collect()
    got = {r["text"]: r["language"]["lang_pred"] != "und" for r in found}
    assert got == {t: any(c.isalpha() for c in t) for t in texts}
    assert not got["½ ² ③"] and not got["①②"] and got["中"]
