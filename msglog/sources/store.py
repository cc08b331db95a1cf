"""Stored logs: a Parquet directory of envelopes, one sub-directory per stream."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msglog.functions.subjects import TokenColumns
from msglog.schema import BATCH, BATCH_ROW, BLOCK, BLOCK_COLUMN, ENVELOPE

# Names starting with '_' are skipped when the directory is read as a log.
HEADS = "_heads"
# Up to this many streams the newest part of each is looked up by a condition of its own.
MAX_HEAD_SCANS = 1000
KEPT_SNAPSHOTS = 8
BATCH_FIELDS = (T.StructField(BATCH, T.StringType()), T.StructField(BATCH_ROW, T.LongType()))


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's shared checkpoint directory."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="msglog-")
    path = os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)  # results are read lazily: what is in the folder goes when the application ends
    return os.path.join(path, "files")


def saved(frame: DataFrame, purpose: str, under: str | None = None) -> DataFrame:
    """Write a frame to the shared folder, or to a folder in it, and read it back: what follows
    starts from files, and using it twice does not compute it twice."""
    spark = frame.sparkSession
    path = os.path.join(under, purpose) if under else shared_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate files."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def token_columns(positions: tuple[int, ...]) -> TokenColumns:
    """Partition columns of a log stored by subject token."""
    return {i: (f"token_{i}", "string") for i in positions}


def stored_schema(positions: tuple[int, ...] = ()) -> T.StructType:
    extra = [T.StructField(name, T.StringType()) for name, _ in token_columns(positions).values()]
    return T.StructType([*ENVELOPE.fields, *extra, T.StructField(BLOCK_COLUMN, T.LongType())])


def open_log(spark: SparkSession, path: str, positions: tuple[int, ...] = (), batches: bool = False) -> DataFrame:
    """Scan a stored log with its declared schema; nothing is inferred. ``batches`` adds which batch a row
    came with, NULL for batches without a number."""
    schema = stored_schema(positions)
    return spark.read.schema(T.StructType([*schema.fields, *BATCH_FIELDS]) if batches else schema).parquet(path)


def open_stream(spark: SparkSession, path: str, positions: tuple[int, ...] = (),
                max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """The same log as a stream; each poll is bounded by files or by bytes."""
    reader = spark.readStream.schema(stored_schema(positions))
    if max_files and max_bytes:
        raise ValueError("bound a poll by files or by bytes, not by both")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def append_log(frame: DataFrame, path: str, positions: tuple[int, ...] = (),
               writers: int | None = None, max_records_per_file: int | None = None) -> None:
    """Append envelopes, partitioned by stream, chosen subject tokens and block of sequences.
    Rows are ordered by sequence inside each file, so that row-group statistics prune reads
    by sequence and time within a block."""
    for i in positions:
        frame = frame.withColumn(f"token_{i}", F.get(F.split("subject", r"\."), F.lit(i)))
    frame = frame.withColumn(BLOCK_COLUMN, F.expr(f"stream_seq div {BLOCK}"))
    parts = ["stream", *[f"token_{i}" for i in positions], BLOCK_COLUMN]
    if writers:
        # Range, not hash: a subject that holds a third of the rows is spread over writers.
        frame = frame.repartitionByRange(writers, *parts, "stream_seq")
    columns = [f.name for f in stored_schema(positions)] + [f.name for f in BATCH_FIELDS if f.name in frame.columns]
    writer = (frame.select(*columns).sortWithinPartitions(*parts, "stream_seq")
              .write.mode("append").partitionBy(*parts))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def log_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Paths of what is in a folder, in order; none where there is no folder."""
    fs, target = _file_system(spark, path)
    return sorted(status.getPath().toString() for status in fs.listStatus(target)) if fs.exists(target) else []


def mark(spark: SparkSession, path: str, name: str) -> None:
    """Leave an empty file in a folder: a statement that is made at once or not at all."""
    fs, target = _file_system(spark, os.path.join(path, name))
    fs.create(target, True).close()


def marked(spark: SparkSession, path: str, name: str) -> bool:
    return log_exists(spark, os.path.join(path, name))


def _snapshots(spark: SparkSession, path: str) -> list[str]:
    """Paths of the head snapshots of a log, oldest first."""
    return list_folder(spark, os.path.join(path, HEADS))


def stream_heads(spark: SparkSession, path: str) -> DataFrame:
    """``(stream, head)``: the last sequence of each stream of a stored log.

    Appends leave a small snapshot of all heads. Only row groups past the newest snapshot are
    looked at, so the cost follows what is new, not the size of the log; a snapshot that is
    missing or old costs a longer look but never a wrong head.
    """
    log = open_log(spark, path).select("stream", BLOCK_COLUMN, "stream_seq")
    snapshots = _snapshots(spark, path)
    if not snapshots:
        return log.groupBy("stream").agg(F.max("stream_seq").alias("head"))
    known = spark.read.schema("stream STRING, head LONG").parquet(snapshots[-1])
    found = known.unionByName(past_heads(log, known).select("stream", F.col("stream_seq").alias("head")))
    return found.groupBy("stream").agg(F.max("head").alias("head"))


def past_heads(log: DataFrame, heads: DataFrame) -> DataFrame:
    """The part of a stored log past ``heads(stream, head)``; streams without a head are whole."""
    few = heads.limit(MAX_HEAD_SCANS + 1).collect()
    if len(few) <= MAX_HEAD_SCANS:
        # One scan: each stream is pruned by its own block, however old its head is.
        newer = [(F.col("stream") == row.stream) & (F.col(BLOCK_COLUMN) >= row["head"] // BLOCK) & (F.col("stream_seq") > row["head"])
                 for row in few]
        return log.where(_any([~F.col("stream").isin([row.stream for row in few]), *newer])) if few else log
    old = heads.select("stream", F.col("head").alias("_old"))
    return (log.join(old, "stream", "left").where(F.col("_old").isNull() | (F.col("stream_seq") > F.col("_old")))
            .select(*log.columns))


def _any(conditions: list) -> Column:
    """A balanced disjunction: a long chain would nest too deep."""
    while len(conditions) > 1:
        conditions = [reduce(lambda a, b: a | b, conditions[i:i + 2]) for i in range(0, len(conditions), 2)]
    return conditions[0]


def record_heads(heads: DataFrame, path: str) -> None:
    """Write the heads of all streams as the newest snapshot; a few older ones are kept."""
    spark = heads.sparkSession
    snapshots = _snapshots(spark, path)
    number = int(os.path.basename(snapshots[-1])) + 1 if snapshots else 0
    heads.select("stream", "head").coalesce(1).write.mode("append").parquet(os.path.join(path, HEADS, f"{number:012d}"))
    for old in snapshots[:-KEPT_SNAPSHOTS]:
        discard(spark, old)
