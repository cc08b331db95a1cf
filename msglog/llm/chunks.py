"""Repeated passages by content-defined chunking with a gear rolling hash.

Cut points: a gear hash rolls over the bytes of a text (A-Z lowered, each run of white space made one
space, so copies that are spaced otherwise are copies); it depends on the last ``GEAR`` bytes only. Its value is read at the word ends, and a word end is a cut
point if it has the smallest value of some ``window`` consecutive word ends. So cut points follow
the content: an insertion moves none beyond its neighbourhood, and no ``window`` word ends are
without one. A chunk runs from a cut point to the first cut point at least ``min_words`` words on;
chunks start at every cut point and overlap, so each is long enough to be no chance repeat.

Chunks with equal 128-bit digests are copies. A passage of n words that stands in several places is
found whatever surrounds it if n > min_words + 2 * window + 2 (the gear's bytes); with the defaults,
every passage of over 50 words. What is reported has ``min_words`` equal words at least.

Scale: digests are counted with the copies of a task combined before the shuffle; only digests that
stand in two places or more are joined back, and a digest held by a third of the rows is a hot key
of an ordinary equality join whose other side has one row for it, which AQE splits. Texts stay out
of all shuffles; only :func:`without_repeats`, which rewrites them, moves them once.

Defined cases: NULL, empty and short texts have no chunks; a passage repeated within one text counts
too; texts of several rows are copies of each other, but rows with one doc_id tie for the first place
and all hold it; a NULL id comes first; texts of any length are read whole; columns but id and text are
not looked at, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msglog.llm.common import free_name, saved

MIN_WORDS = 24
WINDOW = 12
GEAR = 8
_SPACED = bytes(32 if c in (9, 10, 11, 12, 13) else c for c in range(256))


def _gear_table() -> np.ndarray:
    """One pseudo-random 32-bit number for each byte, zero for the space that pads a text's start."""
    return np.array([xxhash.xxh32_intdigest(bytes([c]), 7) for c in range(256)], dtype=np.uint32)


_GEAR = _gear_table()


def gear(flat: np.ndarray) -> np.ndarray:
    """Rolling hash at each byte: the sum of gear[b] * 16**age over the last 8 bytes, by doubling."""
    h = _GEAR[flat]
    step = 1
    while step < GEAR:
        h[step:] = h[step:] + (h[:-step] << np.uint32(4 * step))
        step *= 2
    return h


def word_spans(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in bytes whose white space is spaces."""
    solid = np.concatenate(([False], flat != 32, [False]))
    change = np.flatnonzero(solid[1:] != solid[:-1])
    return change[::2], change[1::2]


def cut_points(values: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions that hold the minimum of some ``window`` consecutive values (the first, on ties)."""
    n = len(values)
    if n < window:
        return np.zeros(0, dtype=np.int64)
    key = (values.astype(np.uint64) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
    span = 1
    while span * 2 <= window:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < window:
        rest = window - span
        key = np.minimum(key[:-rest], key[rest:])
    return np.unique((key & np.uint64(0xFFFFFFFF)).astype(np.int64))


def text_chunks(text: str | None, min_words: int = MIN_WORDS, window: int = WINDOW) -> list[tuple]:
    """(start word, end word, start byte, end byte, digest) of the chunks of a text; ends exclusive."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower().translate(_SPACED)
    starts, ends = word_spans(np.frombuffer(raw, dtype=np.uint8))
    even = b" ".join(raw.split())  # one space between words: what is hashed
    upto = np.cumsum(ends - starts + 1) - 1
    since = upto - (ends - starts)
    n = len(starts)
    if n >= min_words + window:
        cuts = cut_points(gear(np.frombuffer(even, dtype=np.uint8))[upto - 1], window)  # a cut lies behind the word
        last = np.searchsorted(cuts, cuts + min_words)
        inside = last < len(cuts)
        first, final = cuts[inside] + 1, cuts[last[inside]]
    else:
        first = final = np.zeros(0, dtype=np.int64)
    if not len(first) and n >= min_words:  # too short for cut points: one chunk, so that copies of it are found
        first, final = np.array([0]), np.array([n - 1])
    digest = xxhash.xxh3_128_digest
    return [(w, v + 1, a, b, digest(even[x:y]))
            for w, v, a, b, x, y in zip(first.tolist(), final.tolist(), starts[first].tolist(), ends[final].tolist(),
                                        since[first].tolist(), upto[final].tolist(), strict=True)]


CHUNK = ("row long, doc_id long, start_word int, end_word int, start_byte int, end_byte int, "
         "digest_high long, digest_low long")
DIGEST = ["digest_high", "digest_low"]


def chunks(rows: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW) -> DataFrame:
    """Chunk rows of ``rows(row, doc_id, text)``."""
    names = [c.split()[0] for c in CHUNK.split(", ")]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        row, doc_id, a, b, c, d, digest = list(zip(*out, strict=True)) if out else [[]] * 7
        halves = np.frombuffer(b"".join(digest), dtype="<i8").reshape(-1, 2)
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(v, k) for v, k in zip((row, doc_id, a, b, c, d), kinds, strict=True)),
             pa.array(halves[:, 0]), pa.array(halves[:, 1])], names=names)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2),
                                         strict=True):
                out += [(row, doc_id, *c) for c in text_chunks(text.as_py(), min_words, window)]
                if len(out) >= 50_000:
                    yield batch_of(out)
                    out = []
            yield batch_of(out)

    return rows.select("row", F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(step, CHUNK)


def repeated_chunks(rows: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW) -> DataFrame:
    """Chunks whose digest stands in two places or more, with ``copies``, ``first_doc_id`` and
    ``first`` (whether this is the first place, by doc_id and position).

    The chunks are made twice, once to count and once to join: that is cheaper than keeping them. The
    shared digests are written out, so that both sides of the join are plain shuffles and AQE can
    split a digest that many chunks have.
    """
    place = F.struct(F.col("doc_id").alias("first_doc_id"), F.col("start_word").alias("first_word"))
    shared = saved(chunks(rows, min_words, window).groupBy(*DIGEST)
                   .agg(F.count("*").alias("copies"), F.min(place).alias("place"))
                   .where("copies > 1").select(*DIGEST, "copies", "place.*"), "digests")
    return (chunks(rows, min_words, window).join(shared, DIGEST)
            .withColumn("first", F.col("doc_id").eqNullSafe(F.col("first_doc_id"))
                        & (F.col("start_word") == F.col("first_word"))))


def spans(repeated: DataFrame) -> DataFrame:
    """Overlapping or adjoining repeated chunks of a row as one span: (row, doc_id, kept, start_word,
    end_word, start_byte, end_byte, copies, first_doc_id). ``kept`` spans are first places; the other
    spans have an earlier copy. A window holds the chunks of one document."""
    of_row = Window.partitionBy("row", "first").orderBy("start_word")
    begins = F.coalesce(F.col("start_word") > F.lag("end_word").over(of_row), F.lit(True))
    numbered = repeated.withColumn("begins", begins.cast("int")).withColumn("span", F.sum("begins").over(of_row))
    return (numbered.groupBy("row", "first", "span")
            .agg(F.first("doc_id").alias("doc_id"), F.min("start_word").alias("start_word"),
                 F.max("end_word").alias("end_word"), F.min("start_byte").alias("start_byte"),
                 F.max("end_byte").alias("end_byte"), F.max("copies").alias("copies"),
                 F.min("first_doc_id").alias("first_doc_id"))
            .select("row", "doc_id", F.col("first").alias("kept"), "start_word", "end_word", "start_byte", "end_byte",
                    "copies", "first_doc_id"))


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW) -> DataFrame:
    """Spans of all repeated passages of ``docs(doc_id, text)``."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return spans(repeated_chunks(rows, min_words, window))


def without_spans(text: str, cut: list[tuple[int, int]]) -> str:
    """A text without byte ranges (ascending, apart) and the white space behind each."""
    raw, out, at = text.encode("utf-8", "surrogatepass"), [], 0
    for start, end in cut:
        out.append(raw[at:start])
        at = end
        while at < len(raw) and raw[at] in b" \t\n\r\x0b\x0c":
            at += 1
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW) -> DataFrame:
    """``docs(doc_id, text, ...)`` whose texts keep only the first place of each repeated chunk; the
    other columns are unchanged. Rows are named by the hash of both columns: like rows, like cuts."""
    key, cut = free_name(docs, "row"), free_name(docs, "cuts")
    rows = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    named = rows.select(F.col(key).alias("row"), "doc_id", "text")
    # Like rows have like chunks: one of each is enough, however often a row is repeated.
    repeated = repeated_chunks(named, min_words, window).where("not first").dropDuplicates(["row", "start_word"])
    cuts = (spans(repeated).groupBy("row")
            .agg(F.sort_array(F.collect_list(F.struct("start_byte", "end_byte"))).alias(cut))
            .withColumnRenamed("row", key))
    names = docs.columns
    at = names.index("text")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if not c else without_spans(t, [(x["start_byte"], x["end_byte"]) for x in c])
                     for t, c in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True)]
            columns = batch.columns[:len(names)]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    joined = rows.join(cuts, key, "left").select(*names, cut)
    return joined.mapInArrow(step, docs.schema)
