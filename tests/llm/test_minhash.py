from __future__ import annotations

import random

import numpy as np
import pytest

from msglog.llm import minhash


def classes(frame) -> dict:
    return {r.key: r["class"] for r in frame.collect()}


def sets_of(texts: dict) -> dict:
    out = {}
    for i, text in texts.items():
        words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        out[i] = {" ".join(words[j:j + 4]) for j in range(max(1, len(words) - 3))} if words else set()
    return out


def by_all_pairs(texts: dict) -> dict:
    sets, label = sets_of(texts), {i: i for i in texts}
    for i in texts:
        for j in texts:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = {x: new if y == old else y for x, y in label.items()}
    return label


def test_classes_agree_with_all_pairs(spark, prose):
    rng, texts = random.Random(4), {}
    for g in range(40):
        words = prose(rng.randint(3, 150)).split()
        for m in range(rng.randint(1, 5)):
            own = list(words)
            for _ in range(rng.randint(0, 1 + len(words) // 30)):
                own[rng.randrange(len(own))] = prose(1)
            texts[100 * g + m] = " ".join(own)
    for n in range(1, 9):
        texts[9000 + n] = texts[9100 + n] = " ".join(f"Short{i}" for i in range(n))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = by_all_pairs(texts)
    assert len(set(want.values())) < len(want) - 40
    found = minhash.near_classes(docs)
    assert classes(found) == want
    assert {r.key: r.n_shingles for r in found.collect()} == {i: len(s) for i, s in sets_of(texts).items()}


def test_a_pair_at_the_bound_is_linked_and_one_below_is_not(spark):
    def pair(n: int) -> list[str]:
        words = [f"w{n}x{i}" for i in range(n + 3)]  # n shingles, of which one word changes four
        return [" ".join(words), " ".join(["y" if i == 10 else w for i, w in enumerate(words)])]

    texts = [*pair(36), *pair(35)]  # 32 of 40, 31 of 39
    assert classes(minhash.near_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))) \
        == {0: 0, 1: 0, 2: 2, 3: 3}


@pytest.mark.parametrize("n", [1, 2, 5, 40, 300, 5000])
def test_every_coordinate_is_filled(n):
    elements = np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64)
    out = minhash.sketch(elements, 256)
    assert (out != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert (out == minhash.sketch(elements[::-1].copy(), 256)).all()


@pytest.mark.parametrize("n,share", [(10, 0.8), (100, 0.5), (1000, 0.8), (1000, 0.3)])
def test_equal_coordinates_estimate_the_similarity(n, share):
    rng, got = np.random.default_rng(n), []
    for _ in range(60):
        both = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        common = round(n * share)
        half = (n - common) // 2
        one, two = both[:common + half], np.concatenate([both[:common], both[common + half:]])
        got.append((minhash.sketch(one) == minhash.sketch(two)).mean())
    assert abs(np.mean(got) - share) < 0.02
    # As concentrated as 256 hash functions: a deviation of 0.03 at most.
    assert np.std(got) < 0.045


def test_a_hot_band_gives_as_many_candidates_as_members(spark):
    nodes = spark.range(5000).selectExpr("id as node", "array(7L, id + 100) as bands")
    assert minhash.candidates(nodes).count() == 4999


def test_odd_rows(spark, odd):
    found = minhash.near_classes(odd)
    assert found.columns == ["key", "n_shingles", "class"]
    got = sorted(((r.key, r.n_shingles, r["class"]) for r in found.collect()), key=str)
    assert sorted(got, key=str) == sorted([
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 5), (5, 1, 5), (None, 1, 5), (6, 1, 6), (7, 29_997, 7),
        (8, 1, 8), (9, 1, 9), (9, 1, 9), (None, 0, None)], key=str)


def test_an_empty_table(spark, none):
    assert minhash.near_classes(none).collect() == []
