"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Seeds: every test item is a list of words (letters and digits, A-Z lowered). Where a document and an item
have a run of ``n`` words or more in common, the seed is the rarest ``n``-gram of the run: an n-gram is
passed over where its neighbour in the run stands in fewer places of the items (or in as many, to its
left), so the rarest always stays. This is decided for each run when the document is read, so
an edited copy that holds only common n-grams has its seed all the same.

Join: hashed n-grams of the items meet those of all documents. Places of an n-gram that have the same
words around them, as in templates, are one class; a class whose neighbour in the run is rarer, and in the
document too, is passed over whole. Each seed fixes a diagonal of the document
against the item; seeds of one item whose windows overlap are one window, the item's length and
``slack`` words to either side. A window is left out when the words it shares with the item, repeats
counted, could not reach ``min_score`` if all of them matched; this loses nothing. In the others,
Smith-Waterman over words (match 2, mismatch -1, gap -1) gives the best local alignment; its share
of the item's own score is the row's ``score``, and ``min_score`` or more makes a hit. What is left
of the window on both sides of a hit is aligned again, until no further score passes; of two hits of
an item that share over half of the shorter one, the better stays.

Limit: a copy that shares no ``n`` words in a row with its item has no seed and is not found.

Scale: distinct items come in blocks of about ``block_items`` and ``block_bytes``, counted, so what is sent to
the tasks is bounded; a longer benchmark takes more scans. A document is aligned in the task that read it: nothing is
shuffled. Meetings are gathered for ``MEETINGS`` at a time, and windows are scored together,
anti-diagonal by word of the item, in slices of bounded size.

Defined cases: NULL and empty texts or items give no rows; items shorter than ``n`` words are seeded
whole; equal items each get their rows; repeated document rows give repeated hits; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msglog.llm.common import ranges, saved, slices

_KEEP = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
MATCH, MISMATCH, GAP = 2, -1, -1
CELLS = 2_000_000  # of the alignments scored together
MEETINGS = 500_000  # of seeds and words of documents, gathered together
EDGE, ANY = 1 << 32, 1 << 33  # in place of a word: the text ends here; the neighbour is no rarer


@dataclass(frozen=True)
class Settings:
    n: int = 3
    slack: int = 12
    min_score: float = 0.5
    block_items: int = 20_000
    block_bytes: int = 8_000_000


def item_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_KEEP).split()


def _hashed(found: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts, one after the other, and the words of each."""
    counts = np.array([len(w) for w in found], dtype=np.int64)
    return np.fromiter(map(crc32, chain.from_iterable(found)), dtype=np.uint64, count=int(counts.sum())), counts


def _grams(h: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of the n-gram at each position; meaningless where it crosses rows."""
    out = np.zeros(len(h), dtype=np.uint64)
    size = max(0, len(h) - n + 1)
    for i in range(n):
        out[:size] = (out[:size] ^ h[i:i + size]) * np.uint64(0x9E3779B97F4A7C15)
        out[:size] ^= out[:size] >> np.uint64(29)
    return out


class Items:
    """A block of test items: their words and the n-grams they may be found by."""

    def __init__(self, rows: list[tuple], n: int):
        """``rows`` are (id, text) or (id, text, how often the item comes)."""
        found = [(i, w, sum(times) or 1) for i, w, times in ((i, item_words(t), times) for i, t, *times in rows) if w]
        self.times = [times for _, _, times in found]
        rows = [(i, w) for i, w, _ in found]
        self.ids = np.array([-1 if i is None else i for i, _ in rows], dtype=np.int64)
        self.null = np.array([i is None for i, _ in rows], dtype=bool)
        self.words, self.counts = _hashed([w for _, w in rows])
        self.starts = np.cumsum(self.counts) - self.counts
        # The n-grams of an item; all words of an item that is shorter than n.
        self.n = n
        grams, item, place = [], [], []
        by_size = np.minimum(self.counts, n)
        for size in np.unique(by_size).tolist():
            chosen = np.flatnonzero(by_size == size)
            code = _grams(self.words, self.words, size)
            count = self.counts[chosen] - size + 1
            at = ranges(self.starts[chosen], count)
            grams.append(code[at])
            item.append(np.repeat(chosen, count))
            place.append(at - np.repeat(self.starts[chosen], count))
        self.sizes = np.unique(by_size).tolist()
        self.gram = np.concatenate(grams) if grams else np.zeros(0, dtype=np.uint64)
        self.item = np.concatenate(item) if item else np.zeros(0, dtype=np.int64)
        self.place = np.concatenate(place) if place else np.zeros(0, dtype=np.int64)
        # The distinct words, and each item's own as item * distinct words + word, with their repeats.
        self.vocabulary, word = np.unique(self.words, return_inverse=True)
        self.own, self.repeats = np.unique(np.repeat(np.arange(len(rows)), self.counts) * len(self.vocabulary) + word, return_counts=True)

    def seeded(self) -> "Items":
        """The same items, with their n-grams in the order of the look-up: by n-gram, and by the words
        before and behind where the n-gram there is rarer (``ANY`` where it is not)."""
        out = object.__new__(Items)
        out.__dict__.update(self.__dict__)
        _, code, times = np.unique(self.gram, return_inverse=True, return_counts=True)
        rank = times[code]
        beside = self.item[1:] == self.item[:-1]
        word = self.starts[self.item] + self.place
        left, right = np.full(len(rank), ANY, dtype=np.uint64), np.full(len(rank), ANY, dtype=np.uint64)
        at = np.flatnonzero(beside & (rank[:-1] <= rank[1:])) + 1
        left[at] = self.words[word[at] - 1]
        at = np.flatnonzero(beside & (rank[1:] < rank[:-1]))
        right[at] = self.words[word[at] + self.n]
        order = np.lexsort((right, left, self.gram))
        out.gram, out.item, out.place = self.gram[order], self.item[order], self.place[order]
        left, right = left[order], right[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (out.gram[1:] != out.gram[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        head = np.flatnonzero(new)
        out.class_gram, out.left, out.right = out.gram[head], left[head], right[head]
        out.bounds = np.append(head, len(order))
        return out


def _positions(texts: list[str], sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Word hashes, their rows, the rows' first words, and (positions, n-gram codes) for each size."""
    h, counts = _hashed([item_words(t) for t in texts])
    row = np.repeat(np.arange(len(texts)), counts)
    out = []
    for size in sizes:
        whole = np.flatnonzero(row[:len(row) - size + 1] == row[size - 1:]) if len(row) >= size else np.zeros(0, np.int64)
        out.append((whole, _grams(h, row, size)[whole]))
    return h, row, np.cumsum(counts) - counts, out


def align(doc: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignments of rows of document windows and items (word codes; -1 and -2 pad).
    Score, and the first and last document column (last exclusive) of the best alignment.

    One step per word of the item; a gap in the item along a row is a running maximum.
    """
    n, wide = doc.shape
    score = np.zeros((n, wide + 1), dtype=np.int32)
    begin = np.tile(np.arange(wide + 1, dtype=np.int32), (n, 1))  # where the alignment of a cell began
    best, first, last = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32)
    slope = -GAP * np.arange(wide + 1, dtype=np.int32)
    here = np.tile(np.arange(wide + 1, dtype=np.int32), (n, 1))
    for j in range(item.shape[1]):
        same = doc == item[:, j:j + 1]
        diagonal = score[:, :-1] + np.where(same, MATCH, MISMATCH)
        up = score[:, 1:] + GAP
        new = np.zeros_like(score)
        new[:, 1:] = np.maximum(diagonal, up)
        origin = here.copy()
        origin[:, 1:] = np.where(diagonal >= up, begin[:, :-1], begin[:, 1:])
        fresh = new <= 0
        new[fresh] = 0
        origin[fresh] = here[fresh]
        # Gaps along the row: new[c] = max over b <= c of new[b] - (c - b), with the origin of that b.
        packed = ((new + slope).astype(np.int64) << 32) | (origin.astype(np.int64))
        packed = np.maximum.accumulate(packed, axis=1)
        score = (packed >> 32).astype(np.int32) - slope
        begin = (packed & 0xFFFFFFFF).astype(np.int32)
        fresh = score <= 0
        score[fresh] = 0
        begin[fresh] = here[fresh]
        top = score.argmax(axis=1)
        value = score[np.arange(n), top]
        better = value > best
        best[better], last[better] = value[better], top[better]
        first[better] = begin[np.arange(n), top][better]
    return best, first, last


def _windows(items: Items, h: np.ndarray, row: np.ndarray, starts: np.ndarray, counts: np.ndarray,
             found: list[tuple[np.ndarray, np.ndarray]], slack: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, item, first word, last word exclusive) of the windows around all seeds, in batches; the
    windows of a row and item come in one."""
    before, behind = np.full(len(h), EDGE, dtype=np.uint64), np.full(len(h), EDGE, dtype=np.uint64)
    same = np.flatnonzero(row[1:] == row[:-1])
    before[same + 1] = h[same]
    same = np.flatnonzero(row[items.n:] == row[:len(row) - items.n]) if len(row) > items.n else same[:0]
    behind[same] = h[same + items.n]
    met = []
    for position, code in found:
        low = np.searchsorted(items.class_gram, code)
        high = np.searchsorted(items.class_gram, code, side="right")
        some = np.flatnonzero(high > low)
        met.append((position[some], low[some], high[some]))
    at, low, high = (np.concatenate(x) for x in zip(*met, strict=True))
    order = np.argsort(at, kind="stable")
    at, low, high = at[order], low[order], high[order]
    count = items.bounds[high] - items.bounds[low]  # of places of the items: at most so many are seeds
    # Whole rows together; a row with more meetings takes its items by parts.
    of_row = np.bincount(row[at], weights=count, minlength=len(starts)).astype(np.int64)
    group = (np.cumsum(of_row) - of_row) // MEETINGS
    bounds = np.searchsorted(row[at], np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(starts)))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        parts = -(-int(count[a:b].sum()) // (2 * MEETINGS))
        for part in range(parts):
            held = []
            for first in range(a, b, MEETINGS):
                c = count[first:min(b, first + MEETINGS)]
                cuts = np.searchsorted(np.cumsum(c), np.arange(MEETINGS, int(c.sum()) + MEETINGS, MEETINGS))
                lower = 0
                for upper in np.unique(np.minimum(cuts + 1, len(c))).tolist():
                    part_of = slice(first + lower, first + upper)
                    kind = ranges(low[part_of], high[part_of] - low[part_of])
                    where = np.repeat(at[part_of], high[part_of] - low[part_of])
                    rarest = np.flatnonzero((items.left[kind] != before[where]) & (items.right[kind] != behind[where]))
                    kind, where = kind[rarest], where[rarest]
                    places = items.bounds[kind + 1] - items.bounds[kind]
                    seed, where = ranges(items.bounds[kind], places), np.repeat(where, places)
                    mine = items.item[seed] % parts == part
                    held.append((where[mine], seed[mine]))
                    lower = upper
            yield _joined(items, row, starts, counts, *map(np.concatenate, zip(*held, strict=True)), slack)


def _joined(items: Items, row: np.ndarray, starts: np.ndarray, counts: np.ndarray, at: np.ndarray, seed: np.ndarray,
            slack: int) -> tuple[np.ndarray, ...]:
    """The windows of meetings of words and seeds; overlapping ones of a row and item are one."""
    item, r = items.item[seed], row[at]
    begin = at - items.place[seed] - slack
    end = begin + items.counts[item] + 2 * slack
    begin = np.maximum(begin, starts[r])
    end = np.minimum(end, starts[r] + counts[r])
    order = np.lexsort((end, begin, item, r))
    r, item, begin, end = r[order], item[order], begin[order], end[order]
    if not len(r):
        return r, item, begin, end
    # Windows of an item are nearly equally long.
    new = np.ones(len(r), dtype=bool)
    new[1:] = (r[1:] != r[:-1]) | (item[1:] != item[:-1]) | (begin[1:] >= end[:-1])
    head = np.flatnonzero(new)
    return r[head], item[head], begin[head], np.maximum.reduceat(end, head)


def _shared(items: Items, word: np.ndarray, item: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """How many words each window shares with its item, repeats counted; ``word`` numbers the words
    of the documents in the items' vocabulary, -1 elsewhere."""
    out = np.zeros(len(item), dtype=np.int64)
    size = last - first
    cuts = np.searchsorted(np.cumsum(size), np.arange(CELLS, int(size.sum()) + CELLS, CELLS))
    a = 0
    for b in np.unique(np.minimum(cuts + 1, len(size))).tolist():
        w = word[ranges(first[a:b], size[a:b])]
        known = np.flatnonzero(w >= 0)
        window = np.repeat(np.arange(a, b), size[a:b])[known]
        code = item[window] * len(items.vocabulary) + w[known]
        place = np.minimum(np.searchsorted(items.own, code), len(items.own) - 1)
        mine = items.own[place] == code
        pair, times = np.unique(window[mine] * len(items.own) + place[mine], return_counts=True)
        out += np.bincount(pair // len(items.own), np.minimum(times, items.repeats[pair % len(items.own)]), len(out)).astype(np.int64)
        a = b
    return out


def _split(begin: np.ndarray, end: np.ndarray, length: np.ndarray, slack: int) -> tuple[np.ndarray, ...]:
    """Cut long joined windows into overlapping ones, so that a row of repeats is not one matrix."""
    step = length + 2 * slack
    wide = 2 * step
    count = np.maximum(1, -(-(end - begin - step) // step))
    owner = np.repeat(np.arange(len(begin)), count)
    nth = ranges(np.zeros(len(begin), dtype=np.int64), count)
    first = begin[owner] + nth * step[owner]
    return owner, first, np.minimum(end[owner], first + wide[owner])


def _hits(texts: list[str], items: Items, settings: Settings) -> list[tuple]:
    """(row, item, score, first word, last word exclusive) of the texts' best alignments that pass."""
    h, row, starts, found = _positions(texts, items.sizes)
    if not len(h) or not len(items.gram):
        return []
    counts = np.bincount(row, minlength=len(texts))
    word = np.minimum(np.searchsorted(items.vocabulary, h), len(items.vocabulary) - 1)
    word[items.vocabulary[word] != h] = -1
    out: list[tuple] = []
    for r, item, begin, end in _windows(items, h, row, starts, counts, found, settings.slack):
        owner, first, last = _split(begin, end, items.counts[item], settings.slack)
        r, item = r[owner], item[owner]
        hits: list[tuple] = []
        while len(r):
            able = np.flatnonzero(_shared(items, word, item, first, last) >= settings.min_score * items.counts[item])
            r, item, first, last = r[able], item[able], first[able], last[able]
            window, share, a, b = _scored(h, items, settings, item, first, last)
            r, item, first, last = r[window], item[window], first[window], last[window]
            base = starts[r]
            hits += zip(r.tolist(), item.tolist(), share.tolist(), (a - base).tolist(), (b - base).tolist(), strict=True)
            r, item = np.tile(r, 2), np.tile(item, 2)
            first, last = np.append(first, b), np.append(a, last)
        out += _apart(hits)
    return sorted(out)


def _apart(hits: list[tuple]) -> list[tuple]:
    """Without the hits that overlapping windows found twice: the best first."""
    kept: dict[tuple[int, int], list[tuple]] = {}
    for hit in sorted(hits, key=lambda x: (x[0], x[1], -x[2], x[3])):
        near = kept.setdefault(hit[:2], [])
        at = bisect_left(near, hit[3:])
        for other in near[max(0, at - 2):at + 2]:
            if 2 * (min(hit[4], other[1]) - max(hit[3], other[0])) > min(hit[4] - hit[3], other[1] - other[0]):
                break
        else:
            insort(near, (hit[3], hit[4], hit[2]))
    return [(*key, share, a, b) for key, near in kept.items() for a, b, share in near]


def _scored(h: np.ndarray, items: Items, settings: Settings, item: np.ndarray, first: np.ndarray,
            last: np.ndarray) -> tuple[np.ndarray, ...]:
    """(window, share, first word, last word exclusive) of the windows whose best alignment passes."""
    order = np.lexsort((last - first, items.counts[item]))
    out = [(np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
    at = 0
    while at < len(order):
        wide, tall = int((last - first)[order[at]]), int(items.counts[item[order[at]]])
        stop = at + 1
        while stop < len(order) and items.counts[item[order[stop]]] == tall:
            w = max(wide, int((last - first)[order[stop]]))
            if (stop - at + 1) * w > CELLS // 8:
                break
            wide, stop = w, stop + 1
        part = order[at:stop]
        cell = first[part, None] + np.arange(wide)
        docs = np.where(cell < last[part, None], h[np.minimum(cell, len(h) - 1)].astype(np.int64), -1)
        test = items.words[items.starts[item[part], None] + np.arange(tall)].astype(np.int64)
        score, a, b = align(docs, test)
        share = score / (MATCH * tall)
        ok = np.flatnonzero(share >= settings.min_score)
        out.append((part[ok], share[ok], first[part[ok]] + a[ok], first[part[ok]] + b[ok]))
        at = stop
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _seeded(docs: DataFrame, benchmark: DataFrame, settings: Settings) -> Iterator:
    """The items of each block with their seeds, broadcast; a block holds ``block_items`` items or so."""
    # An item that comes more than once is looked for once; its rows are repeated at the end.
    rows = saved(benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).groupBy("item_id", "text")
                 .agg(F.count(F.lit(1)).alias("times")), "items")
    size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-size[0] // settings.block_items), -(-size[1] // settings.block_bytes))
    numbered = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for block in range(blocks):
        items = Items([tuple(r) for r in numbered.where(F.col("block") == block).select("item_id", "text", "times").collect()], settings.n)
        yield docs.sparkSession.sparkContext.broadcast(items.seeded())


def _batch_hits(texts: list[str | None], items: Items, settings: Settings) -> list[tuple]:
    texts = [t or "" for t in texts]
    return [(part[r], *hit) for part in slices(texts) for r, *hit in _hits([texts[i] for i in part], items, settings)]


HITS = "key long, item_id long, score double, first_word int, last_word int"


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """Rows (key, item_id, score, first_word, last_word) of every passage of ``docs(key, text)`` that
    copies an item of ``benchmark(item_id, text)``; words are counted from 0, the last is exclusive."""
    out = None
    for sent in _seeded(docs, benchmark, settings):
        def step(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = sent.value
            for batch in batches:
                ids = batch.column(0).to_pylist()
                hits = [(ids[r], None if items.null[i] else int(items.ids[i]), s, a, b)
                        for r, i, s, a, b in _batch_hits(batch.column(1).to_pylist(), items, settings) for _ in range(items.times[i])]
                cols = list(zip(*hits, strict=True)) if hits else [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                                 names=["key", "item_id", "score", "first_word", "last_word"])

        part = docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string")).mapInArrow(step, HITS)
        out = part if out is None else out.union(part)
    return out


def uncontaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs(text, ...)`` without a copy of an item, unchanged; texts are not shuffled."""
    at, out = docs.columns.index("text"), docs
    for sent in _seeded(docs, benchmark, settings):
        def step(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = sent.value
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[hit[0] for hit in _batch_hits(batch.column(at).to_pylist(), items, settings)]] = False
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(step, docs.schema)
    return out
