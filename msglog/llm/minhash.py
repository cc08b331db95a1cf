"""MinHash near-duplicates by fast similarity sketching.

A text's set is that of its distinct ``k``-word shingles, as XXH64. The sketch has ``size`` coordinates
and is filled in rounds: round i < size throws every element into one coordinate at random, round
i >= size puts every element into coordinate i - size; a coordinate keeps the least (round, hash) it
gets, and no further round is made once all are filled. A set of any size so fills every coordinate after
2 * size rounds at most, the share of equal coordinates of two sets is their Jaccard similarity in the
mean, and it is as concentrated as with ``size`` hash functions of their own, at the cost of a few rounds.

Candidates are sets that agree in one band of ``rows`` coordinates. Two sets of similarity s share none of
the 42 bands with probability (1 - s ** 6) ** 42: 3e-6 at 0.8, 2e-7 at 0.82, 2e-9 at 0.85. Links are
confirmed on the full sets (:mod:`msglog.llm.alike`); classes are the components of the links.

Scale: texts with equal sets are one node from the first aggregation on. A band that many sets share is
reduced to its least node, which every other member is linked to: candidates are as many as members,
never pairs. Full sets are read again for nodes with candidates only and are dealt once.

Defined cases: NULL, empty and blank texts have no shingles and are linked with nothing; a text of fewer
than ``k`` words is one shingle; repeated rows get the same class; NULL ids are never the smallest, and
the class of rows whose ids are all NULL is NULL; texts of any length are read whole; columns but the key
and the text are not looked at, whatever their names; an empty table gives no rows. Two different sets
are taken for one if their 64-bit digests agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msglog.llm import alike
from msglog.llm.common import saved
from msglog.llm.components import components
from msglog.llm.simhash import mixed, shingle_hashes

_VALUE = np.uint64((1 << 40) - 1)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_set(text: str | None, k: int = 4) -> np.ndarray:
    """The distinct shingles of a text, as sorted hashes."""
    return np.unique(shingle_hashes(text, k))


def sketch(elements: np.ndarray, size: int = 256) -> np.ndarray:
    """The coordinates of a set that is not empty; a coordinate holds round and hash of its element."""
    out, done = np.full(size, _EMPTY, dtype=np.uint64), 0
    while done < 2 * size and (out == _EMPTY).any():
        # Rounds are made a few at a time; one too many changes nothing, as a later round never wins.
        rounds = np.arange(done, min(2 * size, done + max(1, 2 * size // len(elements))))
        steps = rounds.astype(np.uint64)[:, None] + np.uint64(1)
        hashes = mixed(elements[None, :], steps)
        thrown = (hashes >> np.uint64(40)) % np.uint64(size)
        bins = np.where(rounds[:, None] < size, thrown, (rounds[:, None] - size).astype(np.uint64))
        values = ((steps - np.uint64(1)) << np.uint64(40)) | (hashes & _VALUE)
        np.minimum.at(out, bins.ravel().astype(np.int64), values.ravel())
        done = int(rounds[-1]) + 1
    return out


def bands(coordinates: np.ndarray, rows: int = 6) -> np.ndarray:
    """One hash for each run of ``rows`` coordinates and its place."""
    n = len(coordinates) // rows
    parts, out = coordinates[:n * rows].reshape(n, rows), np.arange(n, dtype=np.uint64)
    for i in range(rows):
        out = mixed(out ^ parts[:, i], np.uint64(i + 1))
    return out


def signatures(docs: DataFrame, k: int = 4, size: int = 256, rows: int = 6) -> DataFrame:
    """Rows (doc_id, key, node, n_shingles, bands) of ``docs(doc_id, key, text)``: the node is a digest of
    the set, NULL for an empty one."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, found = [], [], []
            for text in batch.column(2):
                elements = shingle_set(text.as_py(), k)
                sizes.append(len(elements))
                nodes.append(np.int64(xxhash.xxh64_intdigest(elements.tobytes()) - (1 << 63)) if len(elements) else None)
                found.append(bands(sketch(elements, size), rows).view(np.int64) if len(elements) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "key", "node", "n_shingles", "bands"])

    return docs.mapInArrow(step, "doc_id long, key long, node long, n_shingles long, bands array<long>")


def candidates(nodes: DataFrame) -> DataFrame:
    """Rows (node, root) of ``nodes(node, bands)``: every node of a band and the least node of it."""
    members = nodes.select("node", F.explode("bands").alias("band"))
    least = members.groupBy("band").agg(F.min("node").alias("root"), F.count("*").alias("n")).where("n > 1").select("band", "root")
    return members.join(least, "band").where("node <> root").select("node", "root").distinct()


def near_classes(docs: DataFrame, key: str = "doc_id", k: int = 4, num: int = 4, den: int = 5, size: int = 256,
                 rows: int = 6, piece: int = alike.PIECE_BYTES) -> DataFrame:
    """Rows (key, n_shingles, class) of all documents: the class is the smallest key of the component of
    links with ``den * common >= num * all`` shingles."""
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    found = saved(signatures(texts, k, size, rows), "signatures")
    nodes = saved(found.where("node is not null").groupBy("node")
                  .agg(F.min("doc_id").alias("low"), F.min("key").alias("key"), F.first("bands").alias("bands")), "nodes")
    links = alike.held_links(texts.select("key", "text"), nodes, candidates(nodes.select("node", "bands")),
                             lambda text: shingle_set(text, k), num, den, piece)
    roots = components(links)
    members = roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
    lows = saved(members.join(nodes.select("node", "low"), "node").groupBy("root").agg(F.min("low").alias("lowest")), "lows")
    classes = saved(nodes.select("node", "low").join(members, "node", "left").join(lows, "root", "left")
                    .select("node", F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("lowest")).alias("class")), "classes")
    # Texts without shingles have no node: a key of their own keeps them out of one partition.
    alone = found.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("class"))
    linked = found.where("node is not null").select("doc_id", "n_shingles", "node").join(classes, "node")
    return linked.select("doc_id", "n_shingles", "class").union(alone).withColumnRenamed("doc_id", "key")
