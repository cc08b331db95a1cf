"""Side tables of a stored log: what look-ups need without reading the log.

``extend`` brings them up to date with one look at the rows that were appended since: message ids by
hash bucket, in files that are sorted by time and have a Bloom filter of their ids, message counts by span of sequences and first subject token, and statistics with a
mergeable sketch of the subjects. Each step leaves a folder with a marker that only a finished write
leaves; it also holds the head up to which every stream is covered. What lies past that is always looked
up in the log itself, so side tables that are missing, old or half-written cost time but never a wrong
result. Small steps are merged into one.

Names start with '_' and are skipped when the directory is read as a log.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msglog.sources.store import (discard, list_folder, log_exists, mark, marked, open_log, past_heads, stream_heads)

STEPS, IDS = "_side", "_ids"
# Sequences of a counted span, in bits.
COUNT_BITS = 16
ID_BUCKETS = 16
ID_ROWS = 10_000_000
KEPT_STEPS = 32
# Batches of up to this many ids name them, so that Bloom filters of the id files are asked.
NAMED_IDS = 200
_SCHEMA = "stream STRING, token STRING, span LONG, n LONG, first_seq LONG, last_seq LONG, subjects BINARY"
_ID_SCHEMA = "stream STRING, msg_id STRING, stream_seq LONG, timestamp TIMESTAMP, bucket INT"


def _steps(spark: SparkSession, path: str) -> list[str]:
    """Finished steps, oldest first. A merged step names, in its marker, the first one that it does not hold."""
    folders = [f for f in list_folder(spark, os.path.join(path, STEPS)) if marked(spark, f, "_done")]
    merged = [i for i, f in enumerate(folders) if marked(spark, f, "_merged")]
    return folders[merged[-1]:] if merged else folders


def _read(spark: SparkSession, path: str) -> DataFrame:
    steps = _steps(spark, path)
    return spark.read.schema(_SCHEMA).parquet(*steps) if steps else spark.createDataFrame([], _SCHEMA)


def covered(spark: SparkSession, path: str) -> DataFrame:
    """``(stream, head)``: the last sequence of each stream that the side tables know."""
    return _read(spark, path).groupBy("stream").agg(F.max("last_seq").alias("head"))


def tail(spark: SparkSession, path: str, positions: tuple[int, ...] = ()) -> DataFrame:
    """The part of a log that its side tables do not know; nothing else is read."""
    return past_heads(open_log(spark, path, positions), covered(spark, path))


def _bucket(msg_id: str | Column) -> Column:
    return F.pmod(F.xxhash64(msg_id), F.lit(ID_BUCKETS)).cast("int")


def extend(spark: SparkSession, path: str, n_ids: int | None = None) -> None:
    """Bring the side tables up to date; ``n_ids`` is the number of new ids, where it is known. Ids come first:
    without the step that covers them they are looked up twice, which is harmless."""
    new, steps = tail(spark, path), list_folder(spark, os.path.join(path, STEPS))
    ids = new.where(F.col("msg_id").isNotNull())
    n_ids = ids.count() if n_ids is None else n_ids
    if n_ids:
        _write_ids(ids.withColumn("bucket", _bucket("msg_id")), _id_folder(spark, path), n_ids)
    number = int(os.path.basename(steps[-1])) + 1 if steps else 0
    folder = os.path.join(path, STEPS, f"{number:012d}")
    token = F.split_part("subject", F.lit("."), F.lit(1))
    counted = new.groupBy("stream", token.alias("token"), F.shiftright("stream_seq", COUNT_BITS).alias("span")).agg(
        F.count(F.lit(1)).alias("n"), F.min("stream_seq").alias("first_seq"), F.max("stream_seq").alias("last_seq"),
        F.hll_sketch_agg("subject").alias("subjects"))
    counted.coalesce(1).write.mode("overwrite").parquet(folder)
    mark(spark, folder, "_done")
    if len(_steps(spark, path)) > KEPT_STEPS:
        _merge(spark, path, number + 1)


def _merge(spark: SparkSession, path: str, number: int) -> None:
    """All steps as one; the old ones go once it is finished."""
    old, folder = list_folder(spark, os.path.join(path, STEPS)), os.path.join(path, STEPS, f"{number:012d}")
    (_read(spark, path).groupBy("stream", "token", "span").agg(
        F.sum("n").alias("n"), F.min("first_seq").alias("first_seq"), F.max("last_seq").alias("last_seq"),
        F.hll_union_agg("subjects").alias("subjects")).coalesce(1).write.mode("overwrite").parquet(folder))
    mark(spark, folder, "_merged")
    mark(spark, folder, "_done")
    for step in old:
        discard(spark, step)


def _id_folder(spark: SparkSession, path: str) -> str:
    """The folder of the id table: the newest finished one that :func:`compact_ids` wrote, or the first."""
    done = [f for f in list_folder(spark, path) if os.path.basename(f).startswith(f"{IDS}-") and marked(spark, f, "_done")]
    return done[-1] if done else os.path.join(path, IDS)


def compact_ids(spark: SparkSession, path: str) -> None:
    """Rewrite the id table with few files: a publish adds up to one to each bucket. To be run between publishes,
    as often as their number doubles; until it is finished the old files count."""
    old = _id_folder(spark, path)
    if not log_exists(spark, old):
        return
    number = int(old.rpartition("-")[2]) + 1 if os.path.basename(old) != IDS else 1
    new = os.path.join(path, f"{IDS}-{number:012d}")
    rows = spark.read.schema(_ID_SCHEMA).parquet(old)
    _write_ids(rows, new, rows.count())
    mark(spark, new, "_done")
    discard(spark, old)


def _write_ids(rows: DataFrame, folder: str, n_ids: int) -> None:
    """One file a bucket, larger ones are cut; a hot time is dealt over all buckets."""
    (rows.select(*(f.split()[0] for f in _ID_SCHEMA.split(", "))).repartition(ID_BUCKETS, "bucket")
     .sortWithinPartitions("bucket", "timestamp").write.mode("append")
     .option("parquet.bloom.filter.enabled#msg_id", "true").option("maxRecordsPerFile", ID_ROWS)
     .option("parquet.bloom.filter.expected.ndv#msg_id", str(max(64, min(ID_ROWS, 2 * n_ids // ID_BUCKETS))))
     .partitionBy("bucket").parquet(folder))


def known_ids(spark: SparkSession, path: str, ids: DataFrame, n_ids: int, since: Column | None = None,
              positions: tuple[int, ...] = ()) -> DataFrame:
    """Rows (stream, msg_id, timestamp) of a log among which all known ones of ``ids(stream, msg_id)`` are. Of the
    id table only the buckets in question are opened, and of them the times; a small batch names its ids, which asks the
    Bloom filters of the files. More rows than asked for may come: they are to be joined by id."""
    late = tail(spark, path, positions).where(F.col("msg_id").isNotNull()).select("stream", "msg_id", "timestamp")
    table = _id_folder(spark, path)
    if log_exists(spark, table):
        stored = spark.read.schema(_ID_SCHEMA).parquet(table)
        if n_ids <= NAMED_IDS:
            names = sorted({r.msg_id for r in ids.select("msg_id").distinct().collect()})
            some = F.lit(False)
            for first in range(0, len(names), 10):  # lists of up to ten are asked one by one
                some = some | F.col("msg_id").isin(names[first:first + 10])
            stored = stored.where(some)
        buckets = [r.b for r in ids.select(_bucket("msg_id").alias("b")).distinct().collect()]
        stored = stored.where(F.col("bucket").isin(buckets))
        if since is not None:
            stored = stored.where(F.col("timestamp") >= since)
        late = late.unionByName(stored.select("stream", "msg_id", "timestamp"))
    return late if since is None else late.where(F.col("timestamp") >= since)


def first_sequences(spark: SparkSession, path: str, n: int, stream: str | None = None, first: int = 0,
                    token: str | None = None) -> int | None:
    """A sequence below which the log has ``n`` messages, as the counts tell, from sequence ``first`` on and, if
    given, of one stream or with one first subject token; NULL if the counts do not reach so far."""
    rows = _read(spark, path).where(F.col("span") >= first >> COUNT_BITS)
    if stream is not None:
        rows = rows.where(F.col("stream") == stream)
    if token is not None:
        rows = rows.where(F.col("token") == token)
    # Spans are few, a row for 65,536 sequences: they are added up in one place.
    total = 0
    for row in rows.groupBy("span").agg(F.sum("n").alias("n")).orderBy("span").toLocalIterator():
        total += row.n
        if total >= n:
            return (row.span + 1) << COUNT_BITS
    return None


def stored_info(spark: SparkSession, path: str, look_past: bool = False) -> DataFrame:
    """Statistics of a stored log from its side tables alone: exact counts and sequences, and an estimate of the
    number of subjects, named ``n_subjects_estimate``. ``look_past`` adds what was appended without them."""
    rows = _read(spark, path).select("stream", "n", "first_seq", "last_seq", "subjects")
    if look_past:
        rows = rows.unionByName(tail(spark, path).groupBy("stream").agg(
            F.count(F.lit(1)).alias("n"), F.min("stream_seq").alias("first_seq"), F.max("stream_seq").alias("last_seq"),
            F.hll_sketch_agg("subject").alias("subjects")))
    return rows.groupBy("stream").agg(
        F.sum("n").alias("n_messages"), F.min("first_seq").alias("first_seq"), F.max("last_seq").alias("last_seq"),
        F.hll_sketch_estimate(F.hll_union_agg("subjects")).alias("n_subjects_estimate"))


def is_covered(spark: SparkSession, path: str) -> bool:
    """Whether the side tables know all that is in the log."""
    ends = stream_heads(spark, path).withColumnRenamed("head", "_head")
    return ends.join(covered(spark, path), "stream", "left").where("head IS NULL OR head < _head").limit(1).count() == 0
