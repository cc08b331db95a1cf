from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from msglog.llm import vafile

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows: list, n: int, rounds: int, size: int = 64, scale: int = 64) -> dict:
    """The same by comparing everything with everything, in Python integers."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    centroids = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:n]]
    for turn in range(rounds + 1):
        at = [min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c)) for _, v in kept]
        if turn < rounds:
            for c in set(at):
                own = [v for a, (_, v) in zip(at, kept, strict=True) if a == c]
                centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    out = [(i, c, far(v, centroids[c])) for (i, v), c in zip(kept, at, strict=True)]
    return {"rows": sorted(out), "inertia": sum(r[2] for r in out),
            "sha": {c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest() for c in set(at)}}


def vectors(n: int, seed: int = 1, centers: int = 5) -> list:
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centers, 64))
    return [(i, (middle[i % centers] + rng.normal(scale=0.3, size=64)).astype(np.float32).tolist()) for i in range(n)]


def check(spark, rows: list, n: int, rounds: int = 3) -> list:
    found = vafile.clusters(spark.createDataFrame(rows, SCHEMA), n=n, rounds=rounds).collect()
    want = plain(rows, n, rounds)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in found) == want["rows"]
    assert {r.inertia for r in found} <= {want["inertia"]}
    assert {r.cluster: r.centroid_sha256 for r in found} == want["sha"]
    for r in found:
        assert r.cluster_inertia == sum(x[2] for x in want["rows"] if x[1] == r.cluster)
    return found


@pytest.mark.parametrize("n,rounds", [(16, 3), (3, 0), (1, 2)])
def test_clusters_agree_with_plain_rounds(spark, n, rounds):
    check(spark, vectors(300), n, rounds)


def test_cells_spare_most_full_comparisons(spark):
    rows = vectors(1000, centers=16)
    found = check(spark, rows, 16)
    assert sum(r.compared for r in found) < 0.4 * 16 * len(rows)


def test_ties_common_and_odd_vectors(spark):
    same, other = [0.5] * 64, [-0.5] * 63 + [0.25]
    bad = [(90, None), (91, []), (92, [1.0] * 63), (93, [1.0] * 63 + [None]), (94, [float("nan")] * 64), (95, [float("inf")] + [0.0] * 63),
           (96, [3e38] + [0.0] * 63)]
    rows = [(i, same) for i in range(200)] + [(200 + i, other) for i in range(20)] + [(7, same), (7, other), (300, [0.0] * 64)]
    found = vafile.clusters(spark.createDataFrame(rows + bad, SCHEMA), n=4).collect()
    want = plain(rows, 4, 3)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in found) == want["rows"]


def test_null_ids_few_vectors_and_clashing_columns(spark):
    rows = [(None, [0.1] * 64), (None, [0.9] * 64), (2, [-3.0] * 64)]
    frame = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA + ", cluster int, distance int, vector string")
    found = vafile.clusters(frame, n=16).collect()
    assert sorted(r.distance for r in found) == [0, 0, 0] and sorted(r.cluster for r in found) == [0, 1, 2]


def test_an_empty_table(spark):
    found = vafile.clusters(spark.createDataFrame([], SCHEMA))
    assert found.collect() == [] and "centroid_sha256" in found.columns


def test_bounds_hold_for_every_vector_and_centroid():
    rng = np.random.default_rng(2)
    data, centroids = rng.integers(-100, 100, (500, 8)), rng.integers(-200, 200, (6, 8))
    cuts = np.sort(rng.integers(-100, 100, (8, vafile.CELLS + 1)), axis=1)
    cuts[:, 0], cuts[:, -1] = data.min(axis=0), data.max(axis=0) + 1
    cells = vafile.cells_of(data, cuts)
    assert (vafile.unpacked(vafile.packed(cells)) == cells).all()
    low, high = vafile.tables(centroids, cuts)
    for c, at in enumerate(centroids):
        exact = (data - at) ** 2
        for d in range(8):
            assert (low[d, cells[:, d], c] <= exact[:, d]).all() and (exact[:, d] <= high[d, cells[:, d], c]).all()
