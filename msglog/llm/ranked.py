"""Ranked lexical search by pipelined term partitioning.

Documents are inverted once, in blocks of up to 8,192: a row of the index is a term of a block with the
numbers of its documents and the term's counts in them. The index is divided by term among four owners: a
term belongs to an owner by the share of documents that hold it, rare terms to the first. Items travel in
bundles. A bundle has, for each block, a sparse list of accumulators (item, document, score), which
starts empty and goes through the owners one after the other: each owner's rows meet it in a cogroup,
add their integer contributions, and the list goes on. The last owner selects.

What travels is cut without changing a result. Before an owner adds, an item may gain at most the
weights of its terms left, each at the greatest value its count allows. If that is below the twentieth
score that the item already has in the block, no further document can come in and those that cannot
reach that score any more leave; equal scores stay.

Scale: the index has a row for each term and block, and only for terms that some item has: hashes of the
items' terms go to the tasks as a sieve of fixed size, and the join with the items confirms them. A
term that stands in every document is one row a block, a group of the cogroup holds one block and one
bundle, so no task holds more whatever the skew. Each block gives 20 documents an item at most to the
final ranking, which ranks in tasks first. Stages are written out, so a lost executor repeats one.

Terms are told apart by their XXH64. Defined cases: NULL texts and texts without terms are no documents and
no items; repeated documents are ranked one by one; equal scores go by doc_id, NULL ids last; an item that
comes more than once with the same text is one item, with another text it is an item of its own; texts of
any length are read whole; columns but id and text are not looked at, whatever their names; no
documents or no items give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msglog.llm.common import SIEVE, saved, sieve

ITEMS = 128
DOCS = 8192
ENTRIES = 2_000_000
# Owners but the last have terms held by fewer than one in so many documents.
OWNERS = (256, 32, 4)

_INDEX = "block long, term long, numbers binary, counts binary, most int, ids array<long>, lengths array<long>"
_CARRIED = ("bundle int, block long, ids array<long>, lengths array<long>, rest array<struct<item:int,owner:int,gain:long>>, "
            "open binary, slots binary, scores binary")
_REST = pa.struct([("item", pa.int32()), ("owner", pa.int32()), ("gain", pa.int64())])
_CARRIED_ARROW = pa.schema([("bundle", pa.int32()), ("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                            ("rest", pa.list_(_REST)), ("open", pa.binary()), ("slots", pa.binary()), ("scores", pa.binary())])
# Letters, digits and all bytes of wide characters make terms; A-Z in lower case.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def term_hash(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term) - (1 << 63)


def item_terms(items: DataFrame, item: str = "item_id", bundle: int = ITEMS) -> tuple[DataFrame, DataFrame, int]:
    """Rows (bundle, number, item) and (bundle, number, term, times), and the number of bundles."""
    plain = saved(items.select(F.col(item).cast("long").alias("item"), F.col("text").cast("string").alias("text"))
                  .where("text is not null").distinct(), "items")
    bundles = -(-plain.count() // bundle)
    number = F.monotonically_increasing_id()
    dealt = saved(plain.repartition(max(1, bundles)).withColumn("id", number), "bundles")
    dealt = dealt.select(F.shiftright("id", 33).cast("int").alias("bundle"),
                         F.col("id").bitwiseAND(F.lit((1 << 33) - 1)).cast("int").alias("number"), "item", "text")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = Counter(terms(batch.column(2)[i].as_py()))
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[i].as_py()] * n, pa.int32()), pa.array([batch.column(1)[i].as_py()] * n, pa.int32()),
                     pa.array([term_hash(t) for t in found], pa.int64()), pa.array(list(found.values()), pa.int64())],
                    names=["bundle", "number", "term", "times"])

    wanted = saved(dealt.select("bundle", "number", "text").mapInArrow(step, "bundle int, number int, term long, times long"), "item-terms")
    return dealt.select("bundle", "number", "item"), wanted, bundles


def _inverted(block: int, ids: list, lengths: list[int], found: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
    """One row for the documents of a block and one for each of its terms."""
    number = np.repeat(np.arange(len(found), dtype=np.uint16), [len(f) for f in found])
    term = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
    times = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int32)
    order = np.argsort(term, kind="stable")
    term, number, times = term[order], number[order], times[order]
    cuts = np.flatnonzero(np.diff(term, prepend=term[:1] - 1 if len(term) else term))
    ends = np.append(cuts[1:], len(term)) if len(cuts) else cuts
    n = len(cuts)
    return pa.RecordBatch.from_arrays([
        pa.array([block] * (n + 1), pa.int64()), pa.array([None, *term[cuts].tolist()], pa.int64()),
        pa.array([None, *(number[a:b].tobytes() for a, b in zip(cuts, ends, strict=True))], pa.binary()),
        pa.array([None, *(times[a:b].tobytes() for a, b in zip(cuts, ends, strict=True))], pa.binary()),
        pa.array([None, *(np.maximum.reduceat(times, cuts).tolist() if n else [])], pa.int32()),
        pa.array([ids] + [None] * n, pa.list_(pa.int64())), pa.array([lengths] + [None] * n, pa.list_(pa.int64()))],
        names=["block", "term", "numbers", "counts", "most", "ids", "lengths"])


def inverted(docs: DataFrame, wanted: DataFrame, key: str = "doc_id", size: int = DOCS) -> DataFrame:
    """The index of ``docs`` for the terms of ``wanted``: documents that have terms, in blocks of up to ``size``."""
    sent = sieve(wanted.select("term").distinct())

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.unpackbits(np.frombuffer(sent.value, dtype=np.uint8))
        known: dict[bytes, int | None] = {}
        block, held = TaskContext.get().partitionId() << 32, 0
        ids, lengths, found, counts = [], [], [], []
        for batch in batches:
            for i in range(batch.num_rows):
                words = terms(batch.column(1)[i].as_py())
                if not words:
                    continue
                got: list[int] = []
                times: list[int] = []
                for term, n in Counter(words).items():
                    if term not in known:
                        if len(known) >= ENTRIES:
                            known.clear()
                        h = term_hash(term)
                        known[term] = h if mask[h % SIEVE] else None
                    if known[term] is not None:
                        got.append(known[term])
                        times.append(n)
                ids.append(batch.column(0)[i].as_py())
                lengths.append(len(words))
                found.append(np.array(got, dtype=np.int64))
                counts.append(np.array(times, dtype=np.int32))
                held += len(got)
                if len(ids) >= size or held >= ENTRIES:
                    yield _inverted(block, ids, lengths, found, counts)
                    block, held = block + 1, 0
                    ids, lengths, found, counts = [], [], [], []
        if ids:
            yield _inverted(block, ids, lengths, found, counts)

    return saved(docs.select(F.col(key).cast("long"), F.col("text").cast("string")).mapInArrow(step, _INDEX), "index")


def weighed(index: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """Rows (bundle, number, term, times, owner, weight, most) of the items' terms that documents hold."""
    held = index.where("term is not null").groupBy("term").agg(
        F.sum(F.expr("octet_length(numbers) div 2")).alias("df"), F.max("most").cast("long").alias("most"))
    owner = F.lit(len(OWNERS))
    for i, part in reversed(list(enumerate(OWNERS))):
        owner = F.when(F.col("df") * part < n, i).otherwise(owner)
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1).cast("double")))
    return wanted.join(held, "term").select("bundle", "number", "term", "times", owner.alias("owner"), weight.alias("weight"), "most")


def _lengths_weighed(lengths: list[int], n: int, total: int) -> np.ndarray:
    return np.array([75 + (25 * x * n) // total for x in lengths], dtype=np.int64)


def _add(left: pa.Table, right: pa.Table, n: int, total: int) -> tuple[dict, np.ndarray, np.ndarray]:
    """The travelling row, its scores (item, document) after an owner has added its own, and its open items."""
    row = {name: left.column(name)[0].as_py() for name in left.column_names}
    m = _lengths_weighed(row["lengths"], n, total)
    items = 1 + max((r["item"] for r in row["rest"]), default=-1)
    scores = np.zeros((items, len(m)), dtype=np.int64)
    slots, held = np.frombuffer(row["slots"], dtype=np.int64), np.frombuffer(row["scores"], dtype=np.int64)
    scores.reshape(-1)[slots] = held
    open_ = np.unpackbits(np.frombuffer(row["open"], dtype=np.uint8))[:items].astype(bool) if row["open"] else np.ones(items, dtype=bool)
    present = (scores > 0) | open_[:, None]
    for i in range(right.num_rows):
        number = np.frombuffer(right.column("numbers")[i].as_py(), dtype=np.uint16)
        times = np.frombuffer(right.column("counts")[i].as_py(), dtype=np.int32).astype(np.int64)
        gain = right.column("weight")[i].as_py() * ((1_000_000_000 * times) // (1000 * times + 12 * m[number]))
        for use in right.column("uses")[i].as_py():
            scores[use["number"], number] += use["times"] * gain
    scores[~present] = 0
    return row, scores, open_


def _owner_step(owner: int, n: int, total: int, keep: int):
    """An owner in the middle of the pipeline: add, then cut what cannot be selected any more."""
    def step(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _CARRIED_ARROW.empty_table()
        row, scores, open_ = _add(left, right, n, total)
        rest = np.zeros(len(scores), dtype=np.int64)
        for r in row["rest"]:
            if r["owner"] > owner:
                rest[r["item"]] += r["gain"]
        if scores.shape[1] >= keep and len(scores):
            least = np.partition(scores, scores.shape[1] - keep, axis=1)[:, scores.shape[1] - keep]
            shut = rest < least
            scores[shut[:, None] & (scores + rest[:, None] < least[:, None])] = 0
            open_ &= ~shut
        slots = np.flatnonzero(scores)
        row |= {"open": np.packbits(open_).tobytes(), "slots": slots.tobytes(), "scores": scores.reshape(-1)[slots].tobytes()}
        return pa.Table.from_pylist([row], schema=_CARRIED_ARROW)

    return step


def _last_step(n: int, total: int, keep: int):
    """The last owner: add, then select the best documents of the block for each item."""
    def step(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        numbers, ids, best = [], [], []
        if left.num_rows:
            row, scores, _ = _add(left, right, n, total)
            doc = np.array([x if x is not None else 0 for x in row["ids"]], dtype=np.int64)
            nameless = np.array([x is None for x in row["ids"]], dtype=bool)
            for i, own in enumerate(scores):
                some = np.flatnonzero(own)
                order = some[np.lexsort((doc[some], nameless[some], -own[some]))][:keep]
                numbers += [i] * len(order)
                ids += [row["ids"][j] for j in order]
                best += own[order].tolist()
        bundle = [left.column("bundle")[0].as_py()] * len(numbers) if left.num_rows else []
        return pa.table({"bundle": pa.array(bundle, pa.int32()), "number": pa.array(numbers, pa.int32()),
                         "doc_id": pa.array(ids, pa.int64()), "score": pa.array(best, pa.int64())})

    return step


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", keep: int = 20,
           bundle: int = ITEMS, size: int = DOCS) -> DataFrame:
    """Rows (item, rank, doc_id, score): the ``keep`` best documents of every item, equal scores by id."""
    named, wanted, bundles = item_terms(items, item, bundle)
    index = inverted(docs, wanted, key, size)
    blocks = index.where("term is null")
    n, total = blocks.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)),
                          F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()
    used = saved(weighed(index, wanted, n), "weighed")
    # What an item can still gain from an owner: each term at its largest count, in a text of no length.
    gain = F.expr(f"times * weight * ((1000000000 * most) div (1000 * most + {12 * 75}))")
    rest = (used.groupBy("bundle", "number", "owner").agg(F.sum(gain).alias("gain"))
            .groupBy("bundle").agg(F.collect_list(F.struct(F.col("number").alias("item"), "owner", "gain")).alias("rest")))
    empty = F.lit(b"")
    carried = (blocks.select(F.explode(F.sequence(F.lit(0), F.lit(max(bundles, 1) - 1))).alias("bundle"), "block", "ids", "lengths")
               .join(rest, "bundle").withColumns({"open": empty, "slots": empty, "scores": empty})
               .select("bundle", "block", "ids", "lengths", "rest", "open", "slots", "scores"))
    uses = used.groupBy("bundle", "term", "owner", "weight").agg(F.collect_list(F.struct("number", "times")).alias("uses"))
    together = lambda frame: frame.groupBy("bundle", "block")
    for owner in range(len(OWNERS) + 1):
        own = (index.where("term is not null").select("block", "term", "numbers", "counts")
               .join(uses.where(F.col("owner") == owner), "term")
               .select(*(F.col(c).alias(c) for c in ("bundle", "block", "numbers", "counts", "weight", "uses"))))
        both = together(carried).cogroup(together(own))
        if owner < len(OWNERS):
            carried = saved(both.applyInArrow(_owner_step(owner, n, total, keep), _CARRIED), f"owner-{owner}")
    found = both.applyInArrow(_last_step(n, total, keep), "bundle int, number int, doc_id long, score long")
    order = Window.partitionBy("bundle", "number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
    return best.join(named, ["bundle", "number"]).select("item", "rank", "doc_id", "score")
