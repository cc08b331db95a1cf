from __future__ import annotations

import itertools
import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from msglog.llm import hmm
from msglog.llm.common import fold

SMALL = hmm.Settings(states=2, iterations=4, class_bits=6, segment=16, smoothing=5.0, block_bytes=2000)


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(3)
    return hmm.Hmm(*(x / x.sum(axis=a, keepdims=True) for x, a in
                     ((rng.random(3), 0), (rng.random((3, 3)), 1), (rng.random((5, 3)), 0))))


def brute(model, sequence):
    """Sums over all paths: the probability, and the expected starts, moves and emissions."""
    k = len(model.start)
    total, starts, moves, emissions = 0.0, np.zeros(k), np.zeros((k, k)), np.zeros_like(model.emit)
    for path in itertools.product(range(k), repeat=len(sequence)):
        p = model.start[path[0]]
        for t, (state, symbol) in enumerate(zip(path, sequence, strict=True)):
            p *= model.emit[symbol, state] * (model.move[path[t - 1], state] if t else 1)
        total += p
        starts[path[0]] += p
        for t, (state, symbol) in enumerate(zip(path, sequence, strict=True)):
            emissions[symbol, state] += p
            if t:
                moves[path[t - 1], state] += p
    return total, starts / total, moves / total, emissions / total


def test_recursions_agree_with_all_paths(model):
    rng = np.random.default_rng(1)
    sequences = [rng.integers(0, 5, n) for n in (1, 6, 3, 4, 1, 7)]
    want = [brute(model, s) for s in sequences]
    assert np.allclose(hmm.forward(sequences, model), [math.log10(w[0]) for w in want])
    for got, i in zip(hmm.expected(sequences, model), (1, 2, 3), strict=True):
        assert np.allclose(got, sum(w[i] for w in want))
    assert len(hmm.forward([], model)) == 0


@pytest.mark.parametrize("segment", [1, 2, 3, 5])
def test_counts_do_not_depend_on_where_a_text_is_cut(model, segment):
    rng = np.random.default_rng(2)
    sequences = [rng.integers(0, 5, n) for n in (1, 6, 3, 8, 1, 7)]
    want = [brute(model, s) for s in sequences]
    for got, i in zip(hmm.expected(sequences, model, segment), (1, 2, 3), strict=True):
        assert np.allclose(got, sum(w[i] for w in want), rtol=1e-4)
    long = [rng.integers(0, 5, n) for n in (5000, 40, 1301, 3)]
    for got, other in zip(hmm.expected(long, model, segment), hmm.expected(long, model, 10_000), strict=True):
        assert np.allclose(got, other, rtol=1e-3)


@pytest.fixture(scope="module")
def tongues(spark):
    """Two tongues that share a few words: states have something to find."""
    rng = random.Random(9)
    words = [[f"{t}{i}" for i in range(40)] + ["and", "of"] for t in "xy"]
    rows = [(i, " ".join(rng.choice(words[i % 2]) for _ in range(rng.randint(1, 90)))) for i in range(200)]
    return spark.createDataFrame([*rows, (900, None), (901, ""), (None, "x1 Y2"), (3, "unseen words")], "doc_id long, text string")


def scored(docs, settings=SMALL):
    return hmm.scores(docs, fold(F.col("doc_id")) == 1, settings)


def test_base_scores_and_counts_agree_with_a_plain_count(tongues):
    rows = [(r.doc_id, (r.text or "").lower().split() + [None]) for r in tongues.collect()]
    held = [crc32(str(i).encode() if i is not None else b"") % 5 == 1 for i, _ in rows]
    counts = Counter(w for (_, words), h in zip(rows, held, strict=True) if not h for w in words)
    total, distinct = sum(counts.values()), len(counts)
    want = sorted((str(i), h, len(w), sum(counts[x] > 0 for x in w), total,
                   round(sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w), 6))
                  for (i, w), h in zip(rows, held, strict=True))
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored(tongues).collect())
    assert got == want


def test_states_beat_single_words_on_held_out_texts(tongues):
    rows = [r for r in scored(tongues).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) + 20


def test_more_passes_never_lose_training_likelihood(tongues):
    def likelihood(n):
        return sum(r.score for r in scored(tongues, hmm.Settings(**{**SMALL.__dict__, "iterations": n, "smoothing": 1e-6})).collect() if not r.held_out)

    assert likelihood(1) < likelihood(3) < likelihood(6)


def test_one_state_is_the_unigram_model(spark):
    docs = spark.createDataFrame([(i, "a b c a") for i in range(30)], "doc_id long, text string")
    for r in scored(docs, hmm.Settings(**{**SMALL.__dict__, "states": 1, "class_bits": 14})).collect():
        assert abs(r.score - r.base_score) < 0.1


def test_odd_rows(odd, none):
    rows = scored(odd).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert scored(none).count() == 0
    everything_held = hmm.scores(odd, F.lit(True), SMALL).collect()
    assert {r.train_tokens for r in everything_held} == {0} and all(math.isfinite(r.score) for r in everything_held)
