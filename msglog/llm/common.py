"""What the operators on training text share: words, folds, staging in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msglog.sources.store import saved, shared_dir  # noqa: F401  (re-exported for the operators)

# Python's bytes.split() and bytes.lower() cut at exactly \x20 and \x09-\x0D and lower exactly A-Z.
SPACES = r"\x20\x09-\x0D"
# Bits of a sieve.
SIEVE = 1 << 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z in lower case; none for NULL."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5


def prepare(spark: SparkSession) -> None:
    """Session settings of the Arrow operators: small batches, so very long texts do not pile up."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def partitions(frame: DataFrame) -> int:
    """Partitions for a shuffle: the session's number, at least one."""
    return max(1, int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The integers start .. start + count - 1 of every pair, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(total)


def slices(texts: list[str], limit: int = 4_000_000) -> Iterator[list[int]]:
    """Row numbers of consecutive texts that hold about ``limit`` characters together."""
    held, size = [], 0
    for i, text in enumerate(texts):
        held.append(i)
        size += len(text)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of the frame has it, in whatever case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sieve(keys: DataFrame) -> Broadcast:
    """The long keys of a one-column frame as a packed bitmap of their remainders by ``SIEVE``. Its size does
    not depend on the rows: what passes it is confirmed by a join, what does not is no key."""
    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.zeros(SIEVE, dtype=bool)
        for batch in batches:
            mask[batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) % SIEVE] = True
        if mask.any():
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(mask).tobytes()])], names=["mask"])

    mask = np.zeros(SIEVE // 8, dtype=np.uint8)
    for row in keys.coalesce(8).mapInArrow(bits, "mask binary").toLocalIterator():
        mask |= np.frombuffer(row[0], dtype=np.uint8)
    return keys.sparkSession.sparkContext.broadcast(mask.tobytes())
