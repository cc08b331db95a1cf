"""SimHash near-duplicates by BK-trees.

A fingerprint has one or more 64-bit words. A bit is 1 if it is set in over half of the hashes of a
text's word shingles, repeats included. Two fingerprints are linked at ``radius`` or fewer
differing bits; classes are the connected components of the links.

Search: fingerprints are reduced to distinct ones and dealt to shards, one for each value of each
block of ``block_bits`` bits. Each shard is a BK-tree: the children of a node are keyed by their
Hamming distance to it, and a search at distance d from a node follows only the edges d - radius ..
d + radius. With ``radius`` < number of blocks, two linked fingerprints agree in one block at least,
so no link is missed; a wider radius is found as often as a block agrees (:func:`near_classes`).

Scale: a shard larger than ``piece`` is split into pieces, and every pair of pieces is a tree and
its queries of their own, so no task holds more than two pieces. The trees of a task are built and
searched together, level by level. A task reports a spanning forest of what it has linked, not the
pairs, so a group of m copies gives m - 1 rows. Exact copies are one fingerprint before any of it.

Near copies of a share of equal shingles (:func:`alike_classes`): the same shards and trees only find
candidates, at a radius wide of the mark, and report a spanning forest of them; links are found by
comparing the full sets of distinct shingles within each component (:mod:`msglog.llm.alike`).

Defined cases: texts without words have fingerprint zero and are linked like any other; texts with
fewer words than a shingle are one shingle; repeated rows get the same class; the class of rows
whose ids are all NULL is NULL; texts of any length are read whole; columns but the key and the text
are not looked at, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msglog.llm import alike
from msglog.llm.common import free_name, partitions, ranges, saved, words
from msglog.llm.components import components, merge_labels

PIECE = 32_768
FRONTIER = 1_000_000
CHUNK = 100_000


def shingle_hashes(text: str | None, k: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every k-word shingle, words joined by one space."""
    found = words(text)
    if not found:
        return np.zeros(0, dtype="<u8")
    flat = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(found) - k + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[min(k, len(found)) - 1:].tolist(), strict=True)
    return np.array([digest(flat[a:b], seed) for a, b in spans], dtype="<u8")


def mixed(hashes: np.ndarray, step: int | np.ndarray) -> np.ndarray:
    """Further hashes of hashes, others for each step (the splitmix64 finaliser)."""
    x = hashes + np.atleast_1d(np.asarray(step, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, dtype=np.int64)
    for first in range(0, len(hashes), 65_536):
        part = np.ascontiguousarray(hashes[first:first + 65_536])
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, k: int = 3, n_words: int = 1) -> list[int]:
    """The fingerprint's words, unsigned."""
    hashes = shingle_hashes(text, k)
    if not len(hashes):
        return [0] * n_words
    return [_majority(hashes if i == 0 else mixed(hashes, i)) for i in range(n_words)]


def fingerprints(docs: DataFrame, key: str = "doc_id", k: int = 3, n_words: int = 1) -> DataFrame:
    """Rows (key, f0 .. f{n-1}); the words are signed longs."""
    names = [f"f{i}" for i in range(n_words)]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [fingerprint(t.as_py(), k, n_words) for t in batch.column(1)]
            rows = np.array(got, dtype="<u8").reshape(-1, n_words).view("<i8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(rows[:, i]) for i in range(n_words))], names=["key", *names])

    return (docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string"))
            .mapInArrow(step, "key long, " + ", ".join(f"{n} long" for n in names)))


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of rows of words."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int32)


class Forest:
    """BK-trees of consecutive groups of distinct fingerprints, one tree for each group."""

    def __init__(self, group: np.ndarray, prints: np.ndarray):
        self.prints, self.wide = prints, prints.shape[1] * 64 + 1
        self.root = np.searchsorted(group, group)
        at = self.root.copy()
        below = np.flatnonzero(at != np.arange(len(at)))  # not placed yet
        keys, nodes = [], []
        while len(below):
            key = at[below] * self.wide + distance(prints[below], prints[at[below]])
            order = np.argsort(key, kind="stable")
            key, rows = key[order], below[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = key[1:] != key[:-1]
            child = rows[new]  # the first on an edge becomes the child, the others go down to it
            keys.append(key[new])
            nodes.append(child)
            at[rows] = np.repeat(child, np.diff(np.append(np.flatnonzero(new), len(key))))
            below = np.sort(rows[~new])
        keys = np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)
        nodes = np.concatenate(nodes) if nodes else np.zeros(0, dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.edge, self.child = keys[order], nodes[order]

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of row numbers at ``radius`` or nearer, in batches; each pair comes from both ends."""
        everyone = np.arange(len(self.prints))
        todo = [(everyone[i:i + FRONTIER // 4], self.root[i:i + FRONTIER // 4])
                for i in range(0, len(everyone), FRONTIER // 4)]
        while todo:
            query, node = todo.pop()
            if len(query) > FRONTIER:
                half = len(query) // 2
                todo += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            far = distance(self.prints[query], self.prints[node])
            near = (far <= radius) & (query != node)
            if near.any():
                yield query[near], node[near]
            base = node * self.wide
            low = np.searchsorted(self.edge, base + np.maximum(far - radius, 0))
            high = np.searchsorted(self.edge, base + np.minimum(far + radius, self.wide - 1), side="right")
            count = high - low
            # Expand in slices, so that one step never makes more than the bound and a slice's rows.
            cuts = np.searchsorted(np.cumsum(count), np.arange(FRONTIER, int(count.sum()) + FRONTIER, FRONTIER))
            first = 0
            for last in np.unique(np.minimum(cuts + 1, len(count))):
                if count[first:last].any():
                    todo.append((np.repeat(query[first:last], count[first:last]),
                                 self.child[ranges(low[first:last], count[first:last])]))
                first = last


def spanning(group: np.ndarray, node: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, smaller linked node) pairs that span the links within each group; rows are sorted by
    group, and a node stands once in a group."""
    label, held, size = np.arange(len(group)), [], 0
    for a, b in Forest(group, prints).links(radius):
        held.append((a, b))
        size += len(a)
        if size > FRONTIER:
            label, held, size = merge_labels(label, *map(np.concatenate, zip(*held, strict=True))), [], 0
    if held:
        label = merge_labels(label, *map(np.concatenate, zip(*held, strict=True)))
    joined = label != np.arange(len(label))
    return node[joined], node[label[joined]]


def _dealt(prints: DataFrame, n_words: int, held: list[str], block_bits: int, piece: int) -> DataFrame:
    """Rows (shard, low, high, node, held ..) of ``prints(node, f0 .., ..)``, each shard or pair of
    its pieces together in one partition."""
    names = [f"f{i}" for i in range(n_words)]
    per_word, mask = 64 // block_bits, (1 << block_bits) - 1
    # The shard: number of the block, then its value.
    shards = F.array(*(
        F.lit((i * per_word + b) << 32).bitwiseOR(F.shiftrightunsigned(F.col(f), b * block_bits).bitwiseAND(F.lit(mask)))
        for i, f in enumerate(names) for b in range(per_word)))
    rows = prints.select(F.explode(shards).alias("shard"), "node", *held)
    large = saved(rows.groupBy("shard").count().where(F.col("count") > piece)
                  .select("shard", F.ceil(F.col("count") / piece).cast("int").alias("pieces")), "shards")
    own = F.pmod(F.xxhash64("node"), F.coalesce("pieces", F.lit(1))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1))
    return (rows.join(large, "shard", "left").select("shard", "node", *held, own.alias("own"), other.alias("other"))
            .select("shard", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                    "node", *held)
            .repartition(partitions(prints), "shard", "low", "high").sortWithinPartitions("shard", "low", "high", "node"))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(group, columns from the node on) of the groups of dealt rows that hold more than one."""
    def flush(parts: list[np.ndarray], end: bool) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        data = np.concatenate(parts)
        new = np.ones(len(data), dtype=bool)
        new[1:] = (data[1:, :3] != data[:-1, :3]).any(axis=1)
        cut = len(data) if end else np.flatnonzero(new)[-1]
        group = np.cumsum(new)[:cut]
        shared = np.bincount(group, minlength=1)[group] > 1 if cut else np.zeros(0, dtype=bool)
        return [data[cut:]], group[shared], data[:cut, 3:][shared]

    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))
        size += batch.num_rows
        if size >= CHUNK:
            held, group, body = flush(held, False)
            size = len(held[0])
            if len(body):
                yield group, body
    if held and size:
        _, group, body = flush(held, True)
        if len(body):
            yield group, body


def links(prints: DataFrame, radius: int, n_words: int = 1, block_bits: int = 16, piece: int = PIECE,
          compared: int | None = None) -> DataFrame:
    """Spanning links (node, root) of distinct fingerprints ``prints(node, f0 ..)``. All words make shards;
    the distance is that of the first ``compared`` ones, or of all."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, body in _groups(batches):
            a, b = spanning(group, body[:, 0], np.ascontiguousarray(body[:, 1:]).view(np.uint64), radius)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["node", "root"])

    names = [f"f{i}" for i in range(compared or n_words)]
    return _dealt(prints, n_words, names, block_bits, piece).mapInArrow(search, "node long, root long")


def near_classes(docs: DataFrame, key: str = "doc_id", k: int = 3, radius: int = 3, n_words: int = 1,
                 block_bits: int = 16, piece: int = PIECE) -> DataFrame:
    """Rows (key, f0 .., class) of all documents; the class is the smallest key of the component.

    Exact while ``radius`` is below ``n_words * (64 // block_bits)``.
    """
    names = [f"f{i}" for i in range(n_words)]
    prints = saved(fingerprints(docs, key, k, n_words), "fingerprints")
    node = F.col("f0") if n_words == 1 else F.xxhash64(*names)
    distinct = saved(prints.groupBy(*names).agg(F.min("key").alias("low")).withColumn("node", node), "distinct")
    roots = components(links(distinct.select("node", *names), radius, n_words, block_bits, piece))
    members = roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
    # The smallest keys of the components are written out: both sides of the joins below are plain
    # shuffles then, and AQE can split a component or a fingerprint that many rows have.
    lows = saved(members.join(distinct.select("node", "low"), "node").groupBy("root").agg(F.min("low").alias("lowest")), "lows")
    by_print = saved(distinct.join(members, "node", "left").join(lows, "root", "left")
                     .select(*names, F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("lowest")).alias("class")), "classes")
    return prints.join(by_print, names)


def _shingle_sets(docs: DataFrame, key: str, k: int, n_words: int) -> DataFrame:
    """Rows (key, node, f0 ..): the node is a hash of the set of distinct shingles, the words are its fingerprint."""
    names = [f"f{i}" for i in range(n_words)]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, got = [], []
            for t in batch.column(1):
                hashes = np.unique(shingle_hashes(t.as_py(), k))
                node.append(xxhash.xxh64_intdigest(hashes.tobytes()))
                got.append([_majority(hashes if i == 0 else mixed(hashes, i)) for i in range(n_words)] if len(hashes) else [0] * n_words)
            rows = np.array(got, dtype="<u8").reshape(-1, n_words).view("<i8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(node, dtype="<u8").view("<i8")), *(pa.array(rows[:, i]) for i in range(n_words))],
                names=["key", "node", *names])

    return (docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string"))
            .mapInArrow(step, "key long, node long, " + ", ".join(f"{n} long" for n in names)))


def alike_classes(docs: DataFrame, key: str, k: int, radius: int, n_words: int, compared: int, block_bits: int,
                  num: int, den: int, piece: int = PIECE, piece_bytes: int = alike.PIECE_BYTES) -> DataFrame:
    """Rows (key, class) of all documents with non-NULL keys: the components of the candidate links whose
    sets of distinct ``k``-word shingles have ``den * common >= num * all``."""
    names = [f"f{i}" for i in range(n_words)]
    rows = saved(_shingle_sets(docs, key, k, n_words), "shingle-sets")
    nodes = saved(rows.groupBy("node").agg(F.min("key").alias("key"), *(F.first(f).alias(f) for f in names)), "nodes")
    texts = docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    found = links(nodes.select("node", *names), radius, n_words, block_bits, piece, compared)
    held = alike.held_links(texts, nodes, found, lambda text: np.unique(shingle_hashes(text, k)), num, den, piece_bytes)
    return (rows.select("key", "node").join(components(held), "node", "left")
            .select("key", F.coalesce("root", "node").alias("class")))


# At a Jaccard similarity of 0.8, 39 of 256 bits differ in the mean, with a deviation of 6; one of 40
# blocks of 12 bits agrees in 99.7 % of cases.
CLEAN = {"k": 5, "n_words": 8, "compared": 4, "radius": 60, "block_bits": 12, "num": 4, "den": 5}


def one_of_each(docs: DataFrame, **settings: int) -> DataFrame:
    """The rows of ``docs(doc_id, text, ...)`` that are the smallest of their class by doc_id; of rows
    alike in both, one. Columns are unchanged. Rows are named by the hash of both columns, so texts
    take part in one join only."""
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    classes = alike_classes(keyed, key, **(CLEAN | settings))
    ids = keyed.select(F.col(key).alias("key"), "doc_id").distinct()
    kept = saved(classes.select("key", "class").distinct().join(ids, "key").groupBy("class")
                 .agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))).alias("kept"))
                 .select(F.col("kept.key").alias(key)), "kept")
    out = keyed.join(kept, key, "left_semi")
    if out.groupBy(key).count().where("count > 1").limit(1).count():  # repeated rows
        out = out.dropDuplicates([key])
    return out.select(*docs.columns)
