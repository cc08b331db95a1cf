from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from msglog.llm import simhash
from msglog.llm.components import components


def brute_print(text, k=3):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(found[i:i + k]), 42) for i in range(max(1, len(found) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(rows, near):
    """Smallest id reachable over links of ``near`` fingerprints."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if near(rows[i][1], rows[j][1]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[find(i)] = min(low.get(find(i), key), key)
    return [low.get(find(i)) for i in range(len(rows))]


def test_fingerprints(prose):
    for text in (None, "", " \n", "One", "one TWO", "a b c", "É é È a b", prose(700)):
        assert simhash.fingerprint(text) == [brute_print(text)]


@pytest.mark.parametrize("piece", [4, 10_000])
def test_classes_agree_with_all_pairs(spark, prose, piece):
    rng = random.Random(3)
    texts = []
    for _ in range(12):
        base = prose(120).split()
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = "edited"
            texts.append(" ".join(copy))
    texts += [None, "", "short", "short"]
    rows = [(i * 7 % 101, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.key: (r.f0 & (1 << 64) - 1, r["class"]) for r in simhash.near_classes(frame, piece=piece).collect()}
    prints = [(i, brute_print(t)) for i, t in rows]
    want = brute_classes(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    assert got == {i: (f, c) for (i, f), c in zip(prints, want, strict=True)}
    assert len(set(want)) < len(rows)


def test_forest_finds_every_link_once_from_each_end():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 62, 5, dtype=np.uint64)
    prints = np.unique(np.array([int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centre for a, b in rng.integers(0, 62, (40, 2))], dtype=np.uint64))
    group = np.sort(rng.integers(0, 3, len(prints)))
    forest = simhash.Forest(group, prints[:, None])
    got = sorted(p for a, b in forest.links(3) for p in zip(a.tolist(), b.tolist(), strict=True))
    want = sorted((i, j) for i in range(len(prints)) for j in range(len(prints)) if i != j and group[i] == group[j]
                  and (int(prints[i]) ^ int(prints[j])).bit_count() <= 3)
    assert got == want and want


def test_long_chains_and_hubs_are_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(200, i) for i in range(201, 260)] + [(5, 5), (None, 3), (61, 60)]
    frame = spark.createDataFrame(links, "node long, root long")
    got = {r.node: r.root for r in components(frame).collect()}
    assert got == {i: 0 for i in range(1, 62)} | {i: 200 for i in range(201, 260)}
    assert components(frame.limit(0)).count() == 0


def test_odd_rows(odd, none):
    rows = simhash.near_classes(odd).collect()
    assert len(rows) == odd.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.key, set()).add((r.f0, r["class"]))
    assert by_id[1] == by_id[2] == by_id[3] == {(0, 1)}  # no words: linked like any other
    assert len({c for _, c in by_id[5]}) == 1 and (by_id[None] & by_id[5])
    assert simhash.near_classes(none).count() == 0


def test_one_of_each_class_stays(spark, prose, odd, none):
    base = prose(300).split()
    near = " ".join(base[:150] + ["changed"] + base[151:])
    far = " ".join(base[:100]) + " " + prose(200)
    rows = [(3, " ".join(base), "a"), (1, near, "b"), (2, " ".join(base), "c"), (4, far, "d"), (1, near, "b"), (9, prose(300), "e"),
            (10, None, "f"), (11, "", "g")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row_key string")
    kept = simhash.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(tuple(r) for r in kept.select("doc_id", "row_key").collect()) == [(1, "b"), (4, "d"), (9, "e"), (10, "f")]
    assert simhash.one_of_each(none).count() == 0
    assert simhash.one_of_each(odd).where("text is not null and text <> ''").count() >= 6


def shares(a, b):
    one, two = ({tuple(x.split()[i:i + 5]) for i in range(max(1, len(x.split()) - 4))} for x in (a, b))
    return len(one & two) / len(one | two)


def test_isolated_pairs_are_dropped_by_their_exact_similarity(spark, prose):
    rng = random.Random(17)
    rows, bands = [], {}
    for i in range(400):
        base = prose(rng.choice([12, 60, 300])).split()
        copy = list(base)
        for at in rng.sample(range(len(copy)), max(1, len(copy) * rng.randint(5, 60) // 1000)):
            copy[at] = "edited"
        similarity = shares(" ".join(base), " ".join(copy))
        band = "below" if similarity < 0.8 else "low" if similarity < 0.85 else "high"
        bands.setdefault(band, set()).add(i)
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    kept = {r.doc_id for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    dropped = {i for i in range(400) if 2 * i + 1 not in kept}
    assert all(2 * i in kept for i in range(400)) and not dropped & bands["below"] and len(bands["below"]) >= 40
    found = {b: (len(bands[b] & dropped), len(bands[b])) for b in ("low", "high")}
    print(found)
    assert found["low"][1] >= 30 and found["low"][0] >= 0.97 * found["low"][1] and found["high"][0] >= 0.99 * found["high"][1]


def test_a_hot_group_is_joined_by_links_that_hold_only(spark, prose):
    # Copies of one text that lie below 0.8 to each other, joined by the text; and a templated group, all below.
    base, template = prose(200).split(), prose(120)
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        copy = list(base)
        for at in range(i % 40, 200, 55):
            copy[at] = f"edit{i}"
        rows.append((i, " ".join(copy)))
    rows += [(i, f"{template} {prose(40)}") for i in range(100, 160)]
    want = brute_classes(rows, lambda a, b: shares(a, b) >= 0.8)
    kept = {r.doc_id for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(want) and len(kept) >= 60
