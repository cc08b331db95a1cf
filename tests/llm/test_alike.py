from __future__ import annotations

import numpy as np
import pytest

from msglog.llm import alike


def near(one: set, two: set, num: int, den: int) -> bool:
    return den * len(one & two) >= num * len(one | two)


def partition(label) -> set:
    groups: dict = {}
    for i, x in enumerate(label):
        groups.setdefault(x, set()).add(i)
    return {frozenset(g) for g in groups.values()}


def by_all_pairs(sets: list[set], num: int, den: int) -> set:
    label = list(range(len(sets)))
    for i, one in enumerate(sets):
        for j in range(i):
            if near(one, sets[j], num, den):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return partition(label)


def flat(sets: list[set]):
    return np.array([len(s) for s in sets]), np.array([x for s in sets for x in sorted(s)], dtype=np.uint64)


@pytest.mark.parametrize("seed", range(30))
@pytest.mark.parametrize("num,den", [(4, 5), (1, 2), (1, 1)])
def test_links_agree_with_all_pairs(seed, num, den, monkeypatch):
    rng = np.random.default_rng(seed)
    if seed % 2:
        monkeypatch.setattr(alike, "PAIRS", 7)
        monkeypatch.setattr(alike, "ELEMENTS", 11)
    sets = []
    for _ in range(rng.integers(1, 8)):
        base = set(rng.integers(0, 400, rng.integers(1, 40)).tolist())
        for _ in range(rng.integers(1, 12)):
            kept = {x for x in base if rng.random() > 0.12}
            sets.append(kept | set(rng.integers(0, 400, rng.integers(0, 5)).tolist()) or {1})
    label = alike.spanning_links(*flat(sets), num, den)
    assert partition(label.tolist()) == by_all_pairs(sets, num, den)


def test_templates_are_not_linked_and_hardly_compared(monkeypatch):
    compared = []
    plain = alike._overlaps
    monkeypatch.setattr(alike, "_overlaps", lambda a, *rest: compared.append(len(a)) or plain(a, *rest))
    sets = [set(range(100)) | {1000 * i + j for j in range(30)} for i in range(1, 500)]
    label = alike.spanning_links(*flat(sets), 4, 5)
    assert len(set(label.tolist())) == 499
    assert sum(compared) == 0


def test_a_large_group_of_near_copies_is_joined_in_linear_time(monkeypatch):
    compared = []
    plain = alike._overlaps
    monkeypatch.setattr(alike, "_overlaps", lambda a, *rest: compared.append(len(a)) or plain(a, *rest))
    sets = [set(range(200)) - {i % 200} | {10_000 + i} for i in range(3000)]
    label = alike.spanning_links(*flat(sets), 4, 5)
    assert set(label.tolist()) == {0}
    assert sum(compared) <= 45 * 3000  # two for each entry of a list at most, not 4.5 million


@pytest.mark.parametrize("piece", [alike.PIECE_BYTES, 400])
def test_groups_cut_into_pieces_lose_no_link(spark, piece):
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(6):
        base = rng.integers(0, 10_000, 60)
        sets += [set(rng.choice(base, 56, replace=False).tolist()) for _ in range(15)]
    texts = [",".join(map(str, sorted(s))) for s in sets]
    docs = spark.createDataFrame(list(enumerate(texts)), "key long, text string")
    nodes = docs.select("key", docs.key.alias("node"))
    chain = spark.createDataFrame([(i, i - 1) for i in range(1, len(sets))], "node long, root long")
    links = alike.held_links(docs, nodes, chain, lambda t: np.array(t.split(","), dtype="<u8"), 4, 5, piece).collect()
    label = list(range(len(sets)))
    for a, b in links:
        old, new = label[a], label[b]
        label = [new if x == old else x for x in label]
    assert partition(label) == by_all_pairs(sets, 4, 5)


def test_no_candidates_and_empty_sets_give_no_links(spark):
    docs = spark.createDataFrame([(1, ""), (2, ""), (2, "")], "key long, text string")
    nodes = docs.select("key", docs.key.alias("node")).distinct()
    empty = lambda t: np.zeros(0, dtype="<u8")
    none = spark.createDataFrame([], "node long, root long")
    assert alike.held_links(docs, nodes, none, empty).collect() == []
    some = spark.createDataFrame([(2, 1)], "node long, root long")
    assert alike.held_links(docs, nodes, some, empty).collect() == []
