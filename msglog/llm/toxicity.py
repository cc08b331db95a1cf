"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, its word pairs and its pairs with one word
between them; words are runs of letters and digits (any character that is not ASCII punctuation or
white space), A-Z in lower case. Each coordinate has a learning rate of its own, and the L1 term
leaves most weights at exactly zero, so what is broadcast is a short list, 2**bits entries at most.

Fitting takes a bounded sample of the labelled rows: ``max_rows`` labels (20,000 by default), drawn
by a hash of the id from all labels outside the held-out fold. FTRL is an online method, so the
sample is read by one task, in the order of that hash, which makes it repeatable. Scoring covers
every text, whole, where it is read, without a shuffle.

Defined cases: NULL and empty texts have no features and get the score of the bias alone; NULL
labels are left out; an id labelled twice counts as toxic if any label says so; an id with several
texts is fitted on one of them; without labels every score is 0.5 - a hair, so nothing is rejected;
texts with equal features have equal scores, and a score of exactly 0.5 is rejected; repeated rows are
scored each; texts of any length are read whole; columns but id and text are not looked at, whatever
their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msglog.llm.common import slices

BITS = 20
_KEEP = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


@dataclass(frozen=True)
class Rates:
    """FTRL-proximal parameters and the passes over the sample."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.1
    epochs: int = 8


def features(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every word, pair and skip-pair of the texts, repeats included."""
    found = [t.encode("utf-8", "surrogatepass").lower().translate(_KEEP).split() for t in texts]
    counts = np.array([len(w) for w in found], dtype=np.int64)
    h = np.fromiter(map(crc32, chain.from_iterable(found)), dtype=np.uint64, count=int(counts.sum()))
    row = np.repeat(np.arange(len(texts)), counts)

    def hashed(x: np.ndarray, kind: int) -> np.ndarray:
        x = (x ^ np.uint64(kind << 40)) * np.uint64(0x9E3779B97F4A7C15)
        return (x >> np.uint64(64 - bits)).astype(np.int64)

    rows, out = [row], [hashed(h, 0)]
    for gap in (1, 2):
        same = row[:-gap] == row[gap:]
        pair = h[:-gap] * np.uint64(0xC2B2AE3D27D4EB4F) + h[gap:]
        rows.append(row[:-gap][same])
        out.append(hashed(pair, gap)[same])
    return np.concatenate(rows), np.concatenate(out)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit_ftrl(rows: list[tuple[np.ndarray, int]], bits: int, rates: Rates) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, features and weights from (distinct features, label) rows, in order."""
    size = (1 << bits) + 1  # the last coordinate is the bias
    z, n = np.zeros(size), np.zeros(size)

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        l1 = np.where(i == size - 1, 0.0, rates.l1)
        w = -(zi - np.sign(zi) * l1) / ((rates.beta + np.sqrt(n[i])) / rates.alpha + rates.l2)
        return np.where(np.abs(zi) > l1, w, 0.0)

    for _ in range(rates.epochs):
        for found, label in rows:
            i = np.append(found, size - 1)
            w = weights(i)
            g = _sigmoid(w.sum()) - label
            grown = n[i] + g * g
            z[i] += g - (np.sqrt(grown) - np.sqrt(n[i])) / rates.alpha * w
            n[i] = grown
    everything = np.arange(size)
    w = weights(everything)
    kept = np.flatnonzero(w[:-1])
    return float(w[-1]), kept, w[kept]


@dataclass(frozen=True)
class Model:
    """Bias and the sparse weights by feature."""

    bits: int
    bias: float
    feature: np.ndarray
    weight: np.ndarray

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits)
        out[self.feature] = self.weight
        return out


def fit(docs: DataFrame, labels: DataFrame, usable: Column, max_rows: int = 20_000, bits: int = BITS,
        rates: Rates = Rates()) -> Model:
    """Fit on ``docs(doc_id, text)`` and ``labels(doc_id, toxic)`` of the ids that are ``usable``."""
    known = (labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
             .where("doc_id is not null and toxic is not null").where(usable)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    total = known.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003))
    known = known.where(draw < int(1_000_003 * min(1.0, max_rows / max(1, total))) + 1)
    # The drawn labels are bounded by max_rows, so they may go to every task.
    sample = (docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
              .join(F.broadcast(known), "doc_id").groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))
              .select("text", "toxic", F.xxhash64("doc_id").alias("place"), "doc_id"))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[np.ndarray, int]] = []
        for batch in batches:
            texts, toxic = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part in slices(texts):
                row, feature = features([texts[i] for i in part], bits)
                pairs = np.unique((row << bits) + feature)
                ends = np.searchsorted(pairs, np.arange(1, len(part) + 1) << bits)
                for i, one in zip(part, np.split((pairs & ((1 << bits) - 1)).astype(np.int32), ends[:-1]), strict=True):
                    rows.append((one, toxic[i]))
        bias, kept, weight = fit_ftrl(rows, bits, rates) if rows else (-1e-6, np.zeros(0, np.int64), np.zeros(0))  # an empty task
        yield pa.RecordBatch.from_arrays([pa.array(np.append(kept, -1)), pa.array(np.append(weight, bias))],
                                         names=["feature", "weight"])

    got = (sample.repartition(1).sortWithinPartitions("place", "doc_id")
           .mapInArrow(train, "feature long, weight double").toPandas().sort_values("feature"))
    if not len(got):  # no labelled rows, no task
        return Model(bits, -1e-6, np.zeros(0, np.int64), np.zeros(0))
    return Model(bits, float(got["weight"].iloc[0]), got["feature"].to_numpy()[1:], got["weight"].to_numpy()[1:])


def _scores(texts: list[str | None], model: Model, weight: np.ndarray) -> np.ndarray:
    bits, out = model.bits, [np.zeros(0)]
    texts = [t or "" for t in texts]
    for part in slices(texts):
        row, feature = features([texts[i] for i in part], bits)
        counts = weight[feature] != 0
        pairs = np.unique((row[counts] << bits) + feature[counts])
        total = np.bincount(pairs >> bits, weights=weight[pairs & ((1 << bits) - 1)], minlength=len(part))
        out.append(_sigmoid(model.bias + total))
    return np.concatenate(out)


def accepted(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs(text, ...)`` whose score is below ``threshold``, unchanged."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        weight = model.dense()
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column(at).to_pylist(), model, weight) < threshold))

    return docs.mapInArrow(step, docs.schema)


def score(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """Rows (key, score) of all documents."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        weight = model.dense()
        for batch in batches:
            got = _scores(batch.column(1).to_pylist(), model, weight)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got)], names=["key", "score"])

    return (docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string"))
            .mapInArrow(step, "key long, score double"))
