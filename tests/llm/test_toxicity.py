from __future__ import annotations

import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from msglog.llm import toxicity
from msglog.llm.common import fold

LABELS = "doc_id long, toxic int"


@pytest.fixture(scope="module")
def labelled(spark, prose):
    """600 texts, a third with an insult; labels say so."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        words = prose(60).split()
        toxic = int(i % 3 == 0)
        if toxic:
            words[rng.randrange(60)] = rng.choice(["Vermin!", "fool,", "wretch"])
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)


@pytest.fixture(scope="module")
def model(labelled):
    return toxicity.fit(*labelled, fold(F.col("doc_id")) != 0)


def test_held_out_accuracy(labelled, model):
    docs, labels = labelled
    rows = toxicity.score(docs, model).join(labels.withColumnRenamed("doc_id", "key"), "key").where(fold(F.col("key")) == 0).collect()
    right = sum((r.score >= 0.5) == (r.toxic == 1) for r in rows)
    assert len(rows) > 90 and right / len(rows) > 0.97
    assert 0 < len(model.feature) < 2000  # L1 leaves few weights


def test_held_out_labels_are_not_learned(spark, labelled, model):
    docs, labels = labelled
    turned = labels.withColumn("toxic", F.when(fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit(docs, turned, fold(F.col("doc_id")) != 0)
    assert again.bias == model.bias and np.array_equal(again.weight, model.weight)


def test_features_are_words_pairs_and_skips():
    row, feature = toxicity.features(["a b c", "", "A, b"], 20)
    assert np.bincount(row).tolist() == [3 + 2 + 1, 0, 2 + 1]
    assert set(feature[row == 2].tolist()) < set(feature[row == 0].tolist())  # a, b and the pair


def test_ftrl_agrees_with_a_plain_loop():
    rng, rates = np.random.default_rng(2), toxicity.Rates(epochs=2, l1=0.3)
    rows = [(np.unique(rng.integers(0, 16, 5)), int(rng.integers(0, 2))) for _ in range(40)]
    z, n = [0.0] * 17, [0.0] * 17

    def weight(i):
        l1 = 0.0 if i == 16 else rates.l1
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - (l1 if z[i] > 0 else -l1)) / ((rates.beta + n[i] ** 0.5) / rates.alpha + rates.l2)

    for _ in range(2):
        for found, label in rows:
            at = [*found.tolist(), 16]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + np.exp(-sum(w.values()))) - label
            for i in at:
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / rates.alpha * w[i]
                n[i] += g * g
    bias, kept, got = toxicity.fit_ftrl(rows, 4, rates)
    want = {i: weight(i) for i in range(16) if weight(i)}
    assert kept.tolist() == sorted(want) and np.allclose(got, [want[i] for i in sorted(want)]) and np.isclose(bias, weight(16))


def test_odd_rows(spark, odd, none, labelled, model):
    scores = toxicity.score(odd, model).collect()
    assert len(scores) == odd.count() and all(0 <= r.score <= 1 for r in scores)
    assert len({r.score for r in scores if r.key in (1, 2, 3)}) == 1  # no words: the bias alone
    assert toxicity.score(none, model).count() == 0
    kept = toxicity.accepted(odd, model)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    strange = spark.createDataFrame([(1, None), (None, 1), (5, 1), (5, 0), (99, 1)], LABELS)
    assert toxicity.fit(odd, strange, F.lit(True)).bits == toxicity.BITS
    empty = toxicity.fit(odd, strange.limit(0), F.lit(True))
    assert all(r.score < 0.5 for r in toxicity.score(odd, empty).collect())


def test_a_bounded_sample_is_drawn_by_id(spark, labelled):
    docs, labels = labelled
    few = toxicity.fit(docs, labels, F.lit(True), max_rows=60)
    assert few.bias == toxicity.fit(docs, labels, F.lit(True), max_rows=60).bias
    assert crc32(b"7") % 5 == spark.range(1).select(fold(F.lit(7))).first()[0]
