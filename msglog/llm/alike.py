"""Links between sets that share a stated part of their elements, out of candidate links.

Two sets are linked if ``den * |A and B| >= num * |A or B|``. Candidates say which sets may be linked;
they need only span: if two sets were found together by whatever way, a chain of candidates joins them.
The components of the candidates are the groups in which links can lie. The sets of a group are dealt
to one task, once, and compared there; a group of more than ``piece`` bytes is cut into pieces, and
every pair of pieces is a group of its own, so no task holds more than two pieces and one set.

In the task: elements are ordered by how many sets of the group have them, rarest first. Two linked
sets share an element among the rarest fifth of each (for a similarity of 0.8), which is the only part
that is looked up, so what is common to a template is no reason to compare. Sets are compared with the
first and the next set of each look-up list, which joins a group of near copies in linear time; then
what is left of different classes in one list is compared in full, in bounded slices. A task reports
a spanning forest of the links that hold, never the pairs.

Defined cases: an empty set has no links; a set that comes more than once is one set; no candidates
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msglog.llm.common import SIEVE, partitions, ranges, saved, sieve
from msglog.llm.components import components, merge_labels

PIECE_BYTES = 16 << 20
CHUNK_BYTES = 4 << 20
PAIRS = 1_000_000
ELEMENTS = 4_000_000


def _overlaps(a: np.ndarray, b: np.ndarray, code: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Common elements of the sets a[i] and b[i]; ``a`` is sorted."""
    out = np.empty(len(a), dtype=np.int64)
    mark = np.zeros(int(code.max()) + 1, dtype=bool)
    heads = np.flatnonzero(np.diff(a, prepend=-1))
    for low, high in zip(heads.tolist(), [*heads[1:].tolist(), len(a)], strict=True):
        own = code[start[a[low]]:start[a[low]] + sizes[a[low]]]
        mark[own] = True
        while low < high:
            total = np.cumsum(sizes[b[low:high]])
            last = low + max(1, int(np.searchsorted(total, ELEMENTS)))
            other = b[low:min(last, high)]
            hit = mark[code[ranges(start[other], sizes[other])]]
            out[low:low + len(other)] = np.add.reduceat(hit, np.cumsum(sizes[other]) - sizes[other], dtype=np.int64)
            low += len(other)
        mark[own] = False
    return out


def spanning_links(sizes: np.ndarray, elements: np.ndarray, num: int, den: int) -> np.ndarray:
    """A label for each set, equal for sets that links join; ``elements`` holds the sets' distinct
    elements, one set after the other, and no set is empty."""
    n, label = len(sizes), np.arange(len(sizes))
    start, owner = np.cumsum(sizes) - sizes, np.repeat(label, sizes)
    _, code, count = np.unique(elements, return_inverse=True, return_counts=True)
    code = code[np.lexsort((code, count[code], owner))]  # each set from its rarest element on
    place = np.arange(len(code)) - start[owner]
    long = sizes - -(-num * sizes // den) + 1  # a link shares one of so many elements of the larger set
    short = sizes - -(-2 * num * sizes // (num + den)) + 1  # and of so many of the smaller
    found = (place < long[owner]) & (count[code] > 1)
    key, row, at = code[found], owner[found], place[found]

    def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pairs = np.unique(a * n + b)
        a, b = pairs // n, pairs % n
        fits = den * np.minimum(sizes[a], sizes[b]) >= num * np.maximum(sizes[a], sizes[b])
        a, b = a[fits], b[fits]
        same = _overlaps(a, b, code, start, sizes) if len(a) else a
        holds = den * same >= num * (sizes[a] + sizes[b] - same)
        return merge_labels(label, a[holds], b[holds])

    order = np.lexsort((row, -sizes[row], key))
    key, row, at = key[order], row[order], at[order]
    head = np.searchsorted(key, key)
    here = np.arange(len(key))
    for other in (head, here - 1):
        rest = np.flatnonzero((here != other) & (other >= head))
        for first in range(0, len(rest), PAIRS):
            part = rest[first:first + PAIRS]
            label = joined(label, row[other[part]], row[part])

    # What is still of different classes in one list: every set meets those of the classes before its own.
    order = np.lexsort((label[row], key))
    key, row, at = key[order], row[order], at[order]
    own = label[row]
    head = np.searchsorted(key, key)
    run = np.ones(len(key), dtype=bool)
    run[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
    before = np.maximum.accumulate(np.where(run, here, 0)) - head if len(key) else head
    ends = np.cumsum(before)
    held, waiting, first = [], 0, 0
    while first < len(key):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PAIRS, side="right")))
        part = np.flatnonzero(before[first:last]) + first
        i, j = ranges(head[part], before[part]), np.repeat(part, before[part])
        a, b = row[i], row[j]
        larger = sizes[a] >= sizes[b]
        small = np.where(larger, b, a)
        least = -(-num * (sizes[a] + sizes[b]) // (num + den))
        keep = ((label[a] != label[b]) & (np.where(larger, at[j], at[i]) < short[small])
                & (np.minimum(sizes[a] - at[i], sizes[b] - at[j]) >= least)
                & (den * np.minimum(sizes[a], sizes[b]) >= num * np.maximum(sizes[a], sizes[b])))
        held.append(np.unique(np.minimum(a, b)[keep] * n + np.maximum(a, b)[keep]))
        waiting += len(held[-1])
        first = last
        if waiting and (waiting >= PAIRS or first >= len(key)):
            pairs = np.unique(np.concatenate(held))
            pairs = pairs[label[pairs // n] != label[pairs % n]]
            label, held, waiting = joined(label, pairs // n, pairs % n), [], 0
    return label


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(group, node, elements) of whole groups of rows (root, low, high, node, elements) sorted by all but
    the last, in chunks; a node stands once in a group, and empty sets are left out."""
    held, sets, size, number = [], [], 0, 0
    last = None
    for batch in batches:
        ids = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
        for row, elements in zip(ids.tolist(), batch.column(4), strict=True):
            group = tuple(row[:3])
            if group != last:
                if size >= CHUNK_BYTES:
                    yield (*np.array(held).T, sets)
                    held, sets, size = [], [], 0
                last, number, node = group, number + 1, None
            body = elements.as_py()
            if row[3] == node or not body:
                continue
            node = row[3]
            held.append((number, node))
            sets.append(body)
            size += len(body)
    if held:
        yield (*np.array(held).T, sets)


def _search(num: int, den: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, node, sets in _sets(batches):
            sizes = np.array([len(s) // 8 for s in sets])
            elements = np.frombuffer(b"".join(sets), dtype="<u8")
            # Elements of different groups are kept apart, so many small groups are one call.
            apart = np.repeat(group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), sizes)
            label = spanning_links(sizes, elements ^ apart, num, den)
            joined = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays([pa.array(node[joined]), pa.array(node[label[joined]])], names=["node", "root"])

    return step


def sets_of(docs: DataFrame, wanted: DataFrame, elements_of) -> DataFrame:
    """Rows (node, root, elements) of ``wanted(key, node, root)``, read from ``docs(key, text)``; a text that
    comes more than once may come more than once. ``elements_of`` gives a text's distinct elements. A
    bitmap of the keys goes to the tasks that read the texts, so that the join gets little more than the
    wanted sets; its size does not depend on the rows."""
    sent = sieve(wanted.select("key"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask, done = np.unpackbits(np.frombuffer(sent.value, dtype=np.uint8)), set()
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(mask[keys.view(np.uint64) % SIEVE]).tolist():  # one at a time: texts may be long
                if keys[i] in done:
                    continue
                done.add(keys[i])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[i:i + 1]), pa.array([elements_of(batch.column(1)[i].as_py()).tobytes()])], names=["key", "elements"])

    return docs.mapInArrow(step, "key long, elements binary").join(wanted, "key").select("node", "root", "elements")


def held_links(docs: DataFrame, nodes: DataFrame, candidates: DataFrame, elements_of, num: int = 4, den: int = 5,
               piece: int = PIECE_BYTES) -> DataFrame:
    """Spanning links (node, root) that hold. ``docs(key, text)`` has the texts, ``nodes(node, key)`` one
    text of each set, ``candidates(node, root)`` any pairs of nodes that span what may be linked."""
    groups = components(candidates)
    members = groups.union(groups.select(F.col("root").alias("node"), "root").distinct())
    wanted = saved(nodes.select("node", "key").join(members, "node"), "wanted")
    sets = saved(sets_of(docs, wanted, elements_of), "sets")
    large = saved(sets.groupBy("root").agg(F.sum(F.octet_length("elements")).alias("bytes")).where(F.col("bytes") > piece)
                  .select("root", F.ceil(F.col("bytes") / piece).cast("int").alias("pieces")), "large")
    own = F.pmod(F.xxhash64("node"), F.coalesce("pieces", F.lit(1))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1))
    dealt = (sets.join(large, "root", "left").select("root", "node", "elements", own.alias("own"), other.alias("other"))
             .select("root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "elements")
             .repartition(partitions(docs), "root", "low", "high").sortWithinPartitions("root", "low", "high", "node"))
    return dealt.mapInArrow(_search(num, den), "node long, root long")
