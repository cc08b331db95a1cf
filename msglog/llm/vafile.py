"""Centroid clustering over a vector approximation file.

Components are scaled to integers. Each component is also kept as the number of one of 16 cells, whose
edges are quantiles of the component over all vectors; a vector's 64 cells are 32 bytes. For a set of
centroids, tables give for each component and cell the least and the greatest squared difference, so
that 64 look-ups bound the distance of a vector to a centroid from below and above. Only centroids whose
interval reaches below the least upper bound can be the nearest. Where one is left, it is taken; where
intervals overlap, the full vector is fetched and compared with those centroids alone. Bounds and
distances are integers, so the result is exact, ties included, whatever the cells.

Scale: cells lie in the same row as the vector, so that a fetch is a look into the row that is being read
(by a join it would scan and move all vectors). A round is one scan without a shuffle: tasks add up their
clusters and send one row for each. The centroids, 16 in the registered query, are all that meets on the
driver. No vector is dealt by its cluster or its value, so a common vector or a large cluster is no
hot group.

Defined cases: vectors that are NULL, of another length or with a component that is NULL, not finite or,
scaled, of 2 ** 27 or more (squared distances would pass a long) are left out; repeated rows and ids are
rows of their own; a NULL id hashes as empty text, and equal hashes are taken in the order of their
vectors; with fewer vectors than centroids each vector is one; an empty table gives no rows; columns but
the id and the vector are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msglog.llm.common import saved
from msglog.operators.splits import values

BITS = 4
CELLS = 1 << BITS
LIMIT = 1 << 27


def integers(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", size: int = 64, scale: int = 64) -> DataFrame:
    """Rows (vec_id, vector): the vectors that count, scaled and rounded down."""
    wide = F.col(column).cast("array<double>")
    good = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT / scale))
    return (vectors.where(F.col(column).isNotNull() & (F.size(column) == size) & good)
            .select(F.col(key).cast("long").alias("vec_id"),
                    F.transform(wide, lambda x: F.floor(x * scale)).cast("array<int>").alias("vector")))


def edges(vectors: DataFrame, size: int) -> np.ndarray:
    """For each component the first value of each cell and, last, the first value past all cells."""
    parts = F.array(*(F.lit(i / CELLS) for i in range(1, CELLS)))
    row = vectors.agg(*(F.array(F.min(x), F.max(x)) for x in (F.get("vector", F.lit(i)) for i in range(size))),
                      *(F.percentile_approx(F.get("vector", F.lit(i)), parts, F.lit(1000)) for i in range(size))).first()
    if row[0][0] is None:
        return np.zeros((size, CELLS + 1), dtype=np.int64)
    return np.array([[low, *inner, high + 1] for (low, high), inner in zip(row[:size], row[size:], strict=True)], dtype=np.int64)


def cells_of(vectors: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The cell of each component of rows of vectors."""
    return np.column_stack([np.searchsorted(cuts[d, 1:-1], vectors[:, d], side="right") for d in range(len(cuts))]).astype(np.uint8)


def packed(cells: np.ndarray) -> np.ndarray:
    return cells[:, 0::2] << BITS | cells[:, 1::2]


def unpacked(pairs: np.ndarray) -> np.ndarray:
    out = np.empty((len(pairs), 2 * pairs.shape[1]), dtype=np.uint8)
    out[:, 0::2], out[:, 1::2] = pairs >> BITS, pairs & (CELLS - 1)
    return out


def tables(centroids: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(component, cell, centroid): the least and the greatest squared difference."""
    first, last = cuts[:, :-1, None], cuts[:, 1:, None] - 1
    at = centroids.T[:, None, :]
    below, above = at - last, first - at
    return np.maximum(np.maximum(below, above), 0) ** 2, np.maximum(np.abs(at - first), np.abs(at - last)) ** 2


def nearest(cells: np.ndarray, vectors: np.ndarray, centroids: np.ndarray, bounds: tuple[np.ndarray, np.ndarray]
            ) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, centroids compared in full) of each row."""
    low = np.zeros((len(cells), len(centroids)), dtype=np.int64)
    high = np.zeros_like(low)
    for d in range(cells.shape[1]):
        low += bounds[0][d, cells[:, d]]
        high += bounds[1][d, cells[:, d]]
    open_ = low <= high.min(axis=1)[:, None]
    out, compared = open_.argmax(axis=1), open_.sum(axis=1)
    row, centroid = np.nonzero(open_ & (compared > 1)[:, None])
    far = np.full(low.shape, np.iinfo(np.int64).max)
    far[row, centroid] = ((vectors[row] - centroids[centroid]) ** 2).sum(axis=1)
    return np.where(compared > 1, far.argmin(axis=1), out), np.where(compared > 1, compared, 0)


def _rows(batch: pa.RecordBatch, name: str, size: int, kind: str) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(kind)
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, size)


def _judged(batch: pa.RecordBatch, size: int, centroids: np.ndarray, bounds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = _rows(batch, "vector", size, "i8")
    return (vectors, *nearest(unpacked(_rows(batch, "cells", size // 2, "u1")), vectors, centroids, bounds))


class Approximated:
    """Vectors with their cells, written out once."""

    def __init__(self, vectors: DataFrame, size: int = 64):
        self.size, self.cuts = size, edges(vectors, size)
        cuts = self.cuts

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pairs = packed(cells_of(_rows(batch, "vector", size, "i8"), cuts))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([p.tobytes() for p in pairs], pa.binary())],
                                                 names=["vec_id", "vector", "cells"])

        self.frame = saved(vectors.mapInArrow(step, "vec_id long, vector array<int>, cells binary"), "approximated")

    def sums(self, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
        """(vectors, sum of each component) of every cluster that has vectors."""
        bounds, size = tables(centroids, self.cuts), self.size

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(centroids), size + 1), dtype=np.int64)
            for batch in batches:
                if batch.num_rows:
                    vectors, cluster, _ = _judged(batch, size, centroids, bounds)
                    np.add.at(total, cluster, np.column_stack([np.ones(len(cluster), dtype=np.int64), vectors]))
            some = np.flatnonzero(total[:, 0])
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some].tolist(), pa.list_(pa.int64()))],
                                             names=["cluster", "total"])

        parts = self.frame.select("vector", "cells").mapInArrow(step, "cluster int, total array<long>")
        rows = parts.groupBy("cluster").agg(*(F.sum(F.get("total", F.lit(i)).cast("decimal(38,0)")) for i in range(size + 1))).collect()
        return {row[0]: (int(row[1]), [int(x) for x in row[2:]]) for row in rows}

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        """Rows (vec_id, cluster, distance, compared) of all vectors."""
        bounds, size = tables(centroids, self.cuts), self.size

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    vectors, cluster, compared = _judged(batch, size, centroids, bounds)
                    far = ((vectors - centroids[cluster]) ** 2).sum(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(far), pa.array(compared.astype(np.int32))],
                        names=["vec_id", "cluster", "distance", "compared"])

        return self.frame.mapInArrow(step, "vec_id long, cluster int, distance long, compared int")


def first_centroids(vectors: DataFrame, n: int, salt: str) -> np.ndarray:
    """The ``n`` vectors whose salted ids have the smallest hashes."""
    named = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(named.alias("hash"), "vector").orderBy("hash", "vector").limit(n).collect()
    return np.array([r.vector for r in rows], dtype=np.int64)


def clusters(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", size: int = 64, scale: int = 64,
             n: int = 16, rounds: int = 3, salt: str = "1:") -> DataFrame:
    """Rows (vec_id, cluster, distance, compared, cluster_inertia, inertia, centroid_sha256) after ``rounds`` of
    assigning all vectors and moving each centroid to the rounded-down mean of its own."""
    spark = vectors.sparkSession
    file = Approximated(integers(vectors, key, column, size, scale), size)
    centroids = first_centroids(file.frame, n, salt)
    if not len(centroids):
        return file.frame.selectExpr("vec_id", "0 as cluster", "0L as distance", "0 as compared", "0L as cluster_inertia",
                                     "0L as inertia", "'' as centroid_sha256")
    for _ in range(rounds):
        for cluster, (count, sums) in file.sums(centroids).items():
            centroids[cluster] = [x // count for x in sums]
    found = saved(file.assigned(centroids), "assigned")
    parts = {r.cluster: r.inertia for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    # One row for each centroid.
    facts = values(spark, [{"cluster": c, "cluster_inertia": inertia, "inertia": sum(parts.values()), "centroid_sha256": digest[c]}
                           for c, inertia in sorted(parts.items())])
    facts = facts.select("cluster", F.col("cluster_inertia").cast("long"), F.col("inertia").cast("long"), "centroid_sha256")
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "compared", "cluster_inertia", "inertia", "centroid_sha256")
