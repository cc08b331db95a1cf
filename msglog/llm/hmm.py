"""A hidden Markov language model: Baum-Welch over all training texts, exact likelihood of every text.

Model: a state emits a class of words, the class emits the word. A word's class is the hash of the
word (``2**class_bits`` classes), the end of a text and all words never seen have one each of their
own, so emission tables are bounded whatever the vocabulary. Within its class a word has the
probability (c + 0.5) / (sum over the class of (c + 0.5)), c its count in the training tokens; the
class of unseen words has 0.5, and its share is the same in all states. States, transitions and
emissions are trained by Baum-Welch; emissions are smoothed towards the classes' overall shares, so
with one state the model is the unigram model.

Training: each task runs the scaled forward and backward recursions over its texts and adds up the
expected counts; Spark sums them by class, the driver gets one row for each class and normalises.
A long text is worked on in segments of ``segment`` tokens side by side: products of the segments'
transition and emission matrices first give the state before and the weights behind each, so the
counts are those of the whole text. Scoring runs the forward recursion over whole texts.

Scale: texts are read once and coded against the vocabulary of their block (about ``block_bytes`` of
text). The vocabularies meet in one shuffle, one row for each word and block, where a window over a
word adds up its counts. However common a word is, it has one row of each block's tens of thousands,
so no word is a larger share of the rows than that; summing by word and joining back would send all
of them twice. The counts go back to their blocks as arrays, and a block is scored by one task. All iterations read the coded texts, one 16-bit
class for each token, from the shared folder.

Defined cases: NULL and empty texts are the end token alone; repeated rows are learned and scored
each; without training texts all probabilities are those of the smoothing; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msglog.llm.common import shared_dir, words

END = b""  # no word is empty


@dataclass(frozen=True)
class Settings:
    states: int = 8
    iterations: int = 6
    class_bits: int = 14
    segment: int = 512
    smoothing: float = 200.0  # tokens' worth of the overall class shares in each state's emissions
    block_bytes: int = 8_000_000
    seed: int = 1

    @property
    def classes(self) -> int:
        """Hashed classes, then the end, then unseen words."""
        return (1 << self.class_bits) + 2


@dataclass(frozen=True)
class Hmm:
    """Initial, transition (from, to) and emission (class, state) probabilities."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


CODED = "kind int, block long, doc_id long, held_out boolean, codes binary, classes binary, word binary, code int, n long, class int"


def coded(docs: DataFrame, held_out: Column, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """The coded texts (block, doc_id, held_out, codes, classes) and the blocks' vocabularies (block,
    word, code, n in training texts, class), both from files in the shared folder."""
    classes, limit = settings.classes, settings.block_bytes
    names = [c.split()[0] for c in CODED.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int32()]

    def batch_of(kind: int, block: int, rows: int, **columns: list) -> pa.RecordBatch:
        columns |= {"kind": [kind] * rows, "block": [block] * rows}
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], t) if c in columns else pa.nulls(rows, t) for c, t in zip(names, kinds, strict=True)], names=names)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        ids: list = []
        held: list[bool] = []
        codes: list[np.ndarray] = []
        vocabulary, size = _Vocabulary(), 0

        def flush() -> Iterator[pa.RecordBatch]:
            listed = list(vocabulary)
            of = np.array([classes - 2 if w == END else xxhash.xxh64_intdigest(w, 42) & (classes - 3) for w in listed], dtype=np.uint16)
            n = np.zeros(len(listed), dtype=np.int64)
            for c, h in zip(codes, held, strict=True):
                if not h:
                    np.add.at(n, c, 1)
            for a in range(0, len(ids), 500):
                part = codes[a:a + 500]
                yield batch_of(0, block, len(part), doc_id=ids[a:a + 500], held_out=held[a:a + 500],
                               codes=[c.tobytes() for c in part], classes=[of[c].tobytes() for c in part])
            for a in range(0, len(listed), 50_000):
                part = listed[a:a + 50_000]
                yield batch_of(1, block, len(part), word=part, code=np.arange(a, a + len(part)), n=n[a:a + 50_000],
                               **{"class": of[a:a + 50_000].astype(np.int32)})

        for batch in batches:
            for doc_id, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                found = words(text.as_py())
                found.append(END)
                codes.append(np.fromiter(map(vocabulary.__getitem__, found), dtype=np.int32, count=len(found)))
                ids.append(doc_id)
                held.append(out)
                size += sum(map(len, found)) + len(found)
                if size >= limit:
                    yield from flush()
                    ids, held, codes = [], [], []
                    vocabulary, size, block = _Vocabulary(), 0, block + 1
        if ids:
            yield from flush()

    rows = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), F.col("text").cast("string"))
    path = shared_dir(docs.sparkSession, "coded")
    rows.mapInArrow(step, CODED).write.partitionBy("kind").option("compression", "zstd").parquet(path)
    everything = docs.sparkSession.read.schema(CODED).parquet(path)
    texts = everything.where("kind = 0").select("block", "doc_id", "held_out", "codes", "classes")
    return texts, everything.where("kind = 1").select("block", "word", "code", "n", "class")


PACKED = "kind int, block long, codes binary, classes binary, counts binary, class int, c long, n long"


def counted(vocabularies: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Counts over all blocks, from files in the shared folder: for each block (block, codes,
    classes, counts), packed, and for each class (class, c, n), the tokens and words of the class.

    Words meet in one shuffle; what goes back to a block are arrays, of each task one or a few.
    """
    spark, classes = vocabularies.sparkSession, settings.classes
    names = [c.split()[0] for c in PACKED.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64()]

    def batch_of(rows: int, **columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], t) if c in columns else pa.nulls(rows, t) for c, t in zip(names, kinds, strict=True)], names=names)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, distinct = np.zeros(classes, dtype=np.int64), np.zeros(classes, dtype=np.int64)
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            block, code, of, c, once = (np.concatenate([x.column(i).to_numpy(zero_copy_only=False) for x in held]) for i in range(5))
            own = once & (c > 0)
            np.add.at(tokens, of[own], c[own])
            np.add.at(distinct, of[own], 1)
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[order])) + 1
            parts = np.split(order, cuts)
            return batch_of(len(parts), kind=[0] * len(parts), block=[int(block[p[0]]) for p in parts],
                            codes=[code[p].astype("<i4").tobytes() for p in parts], classes=[of[p].astype("<u2").tobytes() for p in parts],
                            counts=[c[p].astype("<i8").tobytes() for p in parts])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= 1_000_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()
        some = np.flatnonzero(distinct)
        yield batch_of(len(some), kind=[1] * len(some), **{"class": some, "c": tokens[some], "n": distinct[some]})

    of_word = Window.partitionBy("word")
    rows = vocabularies.select("block", "code", "class", F.sum("n").over(of_word).alias("c"),
                               (F.row_number().over(of_word.orderBy("block")) == 1).alias("once"))
    path = shared_dir(spark, "counted")
    rows.mapInArrow(step, PACKED).write.partitionBy("kind").option("compression", "zstd").parquet(path)
    everything = spark.read.schema(PACKED).parquet(path)
    by_class = everything.where("kind = 1").groupBy("class").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))
    return everything.where("kind = 0").select("block", "codes", "classes", "counts"), by_class


def _by_length(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences, longest first, and for each step how many are that long."""
    order = np.argsort(-lengths, kind="stable")
    return order, np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), side="left")


def forward(sequences: list[np.ndarray], model: Hmm) -> np.ndarray:
    """log10 probability of each class sequence, by the scaled forward recursion."""
    lengths = np.array([len(s) for s in sequences], dtype=np.int64)
    order, active = _by_length(lengths)
    flat = np.concatenate(sequences) if sequences else np.zeros(0, dtype=np.int64)
    base = (np.cumsum(lengths) - lengths)[order]
    out = np.zeros(len(sequences))
    total = np.zeros(len(sequences))
    a = None
    for t, n in enumerate(active.tolist()):
        emit = model.emit[flat[base[:n] + t]]
        a = (np.broadcast_to(model.start, (n, len(model.start))) if a is None else a[:n] @ model.move) * emit
        scale = a.sum(axis=1)
        a = a / scale[:, None]
        total[:n] += np.log10(scale)
    out[order] = total
    return out


@dataclass(frozen=True)
class Cut:
    """Texts cut into segments, and what each segment gets from its neighbours in the same text.

    ``before`` is the state distribution at the end of the segment before (zeros for a text's first
    one), ``after`` the backward weights at its own end, scaled so that the posterior sums to one.
    """

    segments: list[np.ndarray]
    first: np.ndarray
    before: np.ndarray
    after: np.ndarray


def _products(segments: list[np.ndarray], model: Hmm) -> np.ndarray:
    """For each segment the matrix from the distribution before its first token to that behind its
    last one, scaled: entry (i, j) weighs the paths that emit the segment from state i to state j."""
    k = len(model.start)
    out = np.zeros((len(segments), k, k))
    for a in range(0, len(segments), 1000):
        part = segments[a:a + 1000]
        lengths = np.array([len(x) for x in part], dtype=np.int64)
        order, active = _by_length(lengths)
        flat, base = np.concatenate(part), (np.cumsum(lengths) - lengths)[order]
        m = np.tile(np.eye(k), (len(part), 1, 1))
        for t, n in enumerate(active.tolist()):
            here = (m[:n].reshape(n * k, k) @ model.move).reshape(n, k, k) if t else m[:n]
            here = here * model.emit[flat[base[:n] + t]][:, None, :]
            m[:n] = here if t % 8 else here / here.sum(axis=(1, 2), keepdims=True)  # eight factors do not underflow
        out[a + order] = m
    return out


def cut(sequences: list[np.ndarray], model: Hmm, segment: int) -> Cut:
    """The sequences in segments of ``segment`` tokens, which can then be worked on side by side and
    give the expected counts of the whole sequences."""
    k = len(model.start)
    number = np.array([-(-len(s) // segment) for s in sequences], dtype=np.int64)
    segments = [s[i:i + segment] for s in sequences for i in range(0, len(s), segment)]
    base = np.cumsum(number) - number
    first = np.zeros(len(segments), dtype=bool)
    first[base] = True
    before, after = np.zeros((len(segments), k)), np.ones((len(segments), k))
    long = np.flatnonzero(number > 1)
    if len(long):
        at = np.concatenate([np.arange(base[i], base[i] + number[i]) for i in long.tolist()])
        product = np.zeros((len(segments), k, k))
        product[at] = _products([segments[i] for i in at.tolist()], model)
        order, active = _by_length(number[long])
        heads = base[long][order]
        for j, n in enumerate(active.tolist()[1:], 1):  # carry the state to the next segment
            here = heads[:n] + j
            enter = np.broadcast_to(model.start, (n, k)) if j == 1 else before[here - 1] @ model.move
            end = np.einsum("ni,nij->nj", enter, product[here - 1])
            before[here] = end / end.sum(axis=1, keepdims=True)
        for j, n in reversed(list(enumerate(active.tolist()[1:], 1))):
            here = heads[:n] + j
            weight = np.einsum("nij,nj->ni", product[here], after[here]) @ model.move.T
            after[here - 1] = weight / (weight * before[here]).sum(axis=1, keepdims=True)
    return Cut(segments, first, before, after)


def expected(sequences: list[np.ndarray], model: Hmm, segment: int = 512) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, transitions (from, to) and emissions (class, state) of the sequences."""
    whole, start, moves, emissions = cut(sequences, model, segment), 0.0, 0.0, 0.0
    slot = np.cumsum([len(s) for s in whole.segments]) // 500_000
    bounds = [*np.flatnonzero(np.diff(slot, prepend=-1)).tolist(), len(whole.segments)]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        part = slice(a, b)
        got = _expected(Cut(whole.segments[part], whole.first[part], whole.before[part], whole.after[part]), model)
        start, moves, emissions = start + got[0], moves + got[1], emissions + got[2]
    return start, moves, emissions


def _expected(part: Cut, model: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts of some segments, the transitions into them included.

    Tokens lie step by step, the longest segments first, so a step is a slice; single precision
    holds, as every step is scaled.
    """
    lengths = np.array([len(s) for s in part.segments], dtype=np.int64)
    order, active = _by_length(lengths)
    base = (np.cumsum(lengths) - lengths)[order]
    symbol = np.concatenate(part.segments)[np.concatenate([base[:n] + t for t, n in enumerate(active.tolist())])]
    emit = model.emit.astype(np.float32)[symbol]
    move, states = model.move.astype(np.float32), len(model.start)
    first, into, leave = part.first[order], part.before[order].astype(np.float32), part.after[order].astype(np.float32)
    enter = np.where(first[:, None], model.start.astype(np.float32), into @ move)
    back, ones = np.ascontiguousarray(move.T), np.ones(states, dtype=np.float32)
    gamma, scale = np.empty_like(emit), np.empty((len(symbol), 1), dtype=np.float32)
    ends = np.cumsum(active)
    steps = list(zip((ends - active).tolist(), ends.tolist(), strict=True))
    before = None
    for a, b in steps:
        here = gamma[a:b]
        if before is None:
            np.multiply(emit[a:b], enter, out=here)
        else:
            np.matmul(before[:b - a], move, out=here)
            here *= emit[a:b]
        scale[a:b, 0] = here @ ones
        here /= scale[a:b]
        before = here
    emit /= scale
    moves = np.zeros((states, states))
    after = None  # emission times backward probability of the next step, scaled
    for a, b in reversed(steps):
        now = emit[a:b].copy()
        n = 0
        if after is not None:
            n = len(after)
            moves += gamma[a:a + n].T @ after
            beta = after @ back
            gamma[a:a + n] *= beta
            now[:n] *= beta
        gamma[a + n:b] *= leave[n:b - a]
        now[n:] *= leave[n:b - a]
        after = now
    moves += into.T @ after
    emissions = np.stack([np.bincount(symbol, weights=gamma[:, k], minlength=len(model.emit)) for k in range(states)], axis=1)
    return gamma[:steps[0][1]][first].sum(axis=0, dtype=np.float64), moves * model.move, emissions


def _counts_of(texts: DataFrame, model: Hmm, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass of expected counts over all training texts, summed by class."""
    sent = texts.sparkSession.sparkContext.broadcast(model)
    k, classes, segment = settings.states, settings.classes, settings.segment
    columns = [f"s{i}" for i in range(k)]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        total = np.zeros((classes + k + 1, k))  # emissions, then transitions, then starts
        held: list[np.ndarray] = []
        size = 0

        def add() -> None:
            start, moves, emissions = expected(held, model, segment)
            total[:classes] += emissions
            total[classes:classes + k] += moves
            total[-1] += start

        for batch in batches:
            for one in batch.column(0):
                tokens = np.frombuffer(one.as_py(), dtype="<u2").astype(np.int64)
                held.append(tokens)
                size += len(tokens)
                if size >= 500_000:
                    add()
                    held, size = [], 0
        if held:
            add()
        some = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(total[some, i]) for i in range(k))], names=["row", *columns])

    got = (texts.where("not held_out").select("classes").mapInArrow(step, "row long, " + ", ".join(f"{c} double" for c in columns))
           .groupBy("row").agg(*(F.sum(c).alias(c) for c in columns)).toPandas())  # a row for each class and state
    total = np.zeros((classes + k + 1, k))
    total[got["row"].to_numpy(dtype=np.int64)] = got[columns].to_numpy(dtype=np.float64)
    return total[-1], total[classes:classes + k], total[:classes]


def _emissions(weights: np.ndarray, unseen: float) -> np.ndarray:
    """Columns that sum to one, with the same share of unseen words in each."""
    out = np.zeros_like(weights)
    total = weights[:-1].sum(axis=0)
    out[:-1] = weights[:-1] / np.where(total > 0, total, 1) * (1 - unseen)
    out[-1] = unseen
    return out


def train(texts: DataFrame, shares: np.ndarray, settings: Settings) -> Hmm:
    """Baum-Welch from a seeded start; ``shares`` are the classes' shares, that of unseen words last."""
    k, rng = settings.states, np.random.default_rng(settings.seed)
    emit = _emissions(shares[:, None] * np.exp(rng.normal(0.0, 0.5, (len(shares), k))), shares[-1])
    model = Hmm(np.full(k, 1 / k), np.full((k, k), 0.1 / k) + 0.9 * np.eye(k), emit)
    for _ in range(settings.iterations if shares[-1] < 1 else 0):
        start, moves, emissions = _counts_of(texts, model, settings)
        model = Hmm((start + 1) / (start + 1).sum(), (moves + 0.1) / (moves + 0.1).sum(axis=1, keepdims=True),
                    _emissions(emissions + settings.smoothing * shares[:, None], shares[-1]))
    return model


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scores(docs: DataFrame, held_out: Column, settings: Settings = Settings()) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of all documents;
    the model learns from those that are not held out. Scores are log10 probabilities."""
    texts, vocabularies = coded(docs, held_out, settings)
    counts, by_class = counted(vocabularies, settings)
    by_class = by_class.toPandas()  # a row for each class at most
    tokens, distinct = int(by_class["c"].sum()), int(by_class["n"].sum())
    mass = np.zeros(settings.classes)
    mass[by_class["class"].to_numpy(dtype=np.int64)] = (by_class["c"] + 0.5 * by_class["n"]).to_numpy(dtype=np.float64)
    mass[-1] = 0.5
    model = train(texts, mass / mass.sum(), settings)
    sent = docs.sparkSession.sparkContext.broadcast((model, np.log10(np.where(mass > 0, mass, 1))))
    base_log = math.log10(tokens + 0.5 * (distinct + 1))

    def score(texts: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        model, log_mass = sent.value
        code, c_of, class_of = (np.concatenate([np.frombuffer(x, dtype=kind) for x in counts[name]] or [np.zeros(0, dtype=kind)])
                                for name, kind in (("codes", "<i4"), ("counts", "<i8"), ("classes", "<u2")))
        c, of = np.zeros(len(code), dtype=np.int64), np.zeros(len(code), dtype=np.int64)
        c[code], of[code] = c_of, class_of  # a block's codes are 0, 1, 2, ...
        of[c == 0] = len(log_mass) - 1
        log_c = np.log10(c + 0.5)
        codes = [np.frombuffer(x, dtype="<i4") for x in texts["codes"]]
        own = np.array([log_c[x].sum() for x in codes])
        inside = np.array([log_mass[of[x]].sum() for x in codes])
        n = np.array([len(x) for x in codes], dtype=np.int64)
        return pd.DataFrame({
            "doc_id": texts["doc_id"], "held_out": texts["held_out"], "n_tokens": n,
            "n_known": np.array([(c[x] > 0).sum() for x in codes], dtype=np.int64),
            "train_tokens": np.full(len(n), tokens, dtype=np.int64),
            "base_score": own - n * base_log, "score": own - inside + forward([of[x] for x in codes], model)})

    return (texts.select("block", "doc_id", "held_out", "codes").groupBy("block")
            .cogroup(counts.groupBy("block")).applyInPandas(score, SCORES))
