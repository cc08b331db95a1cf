"""Inputs that several queries share: the events log, its splits and its progress tables."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msglog.operators.discovery import discover_filters
from msglog.operators.positions import last_seq
from msglog.operators.splits import FilterSet, match_splits, values, with_split
from msglog.plans.catalog import FOUND
from msglog.sources.adapters import EVENT_TOKENS, events_log

PAYLOAD = T.StructType([T.StructField("k", T.IntegerType())])


def k_of(data: str = "data"):
    return F.from_json(F.decode(data, "UTF-8"), PAYLOAD, {"mode": "FAILFAST"}).k


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_log(spark, sf_dir)


def type_filters(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """A filter for each event type of the log, as discovered: once for each query."""
    if sf_dir not in FOUND:
        FOUND[sf_dir] = tuple(sorted(row["filter"] for row in discover_filters(log(spark, sf_dir), depth=2).collect()))
    return FOUND[sf_dir]


def split_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole events log, read through one split per event type."""
    chosen = FilterSet.of(spark, type_filters(spark, sf_dir))
    return match_splits(log(spark, sf_dir), chosen, "consumer", tokens=EVENT_TOKENS, disjoint=True)


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The splits of that read."""
    return with_split(values(spark, [{"stream": "events", "filter": f} for f in type_filters(spark, sf_dir)]), "consumer")


def n_splits(spark: SparkSession, sf_dir: str) -> int:
    return len(type_filters(spark, sf_dir))


def share_of_log(frame: DataFrame, numerator: int, denominator: int) -> int:
    """A sequence number at a share of the log, so that positions move with its size."""
    return last_seq(frame) * numerator // denominator


def instant(text: str):
    return F.expr(f"TIMESTAMP_NTZ'{text}'")


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message was delivered once; those with k >= 80 a second time, 30 s later."""
    read = split_log(spark, sf_dir)
    times = F.array(
        F.struct(F.lit(1).alias("attempt"), F.col("timestamp").alias("delivered_at")),
        F.when(k_of() >= 80, F.struct(F.lit(2).alias("attempt"),
                                      (F.col("timestamp") + F.expr("INTERVAL 30 SECONDS")).alias("delivered_at"))),
    )
    return (read.select("split_id", "stream_seq", F.explode(times).alias("_d")).where(F.col("_d").isNotNull())
            .select("split_id", "stream_seq", "_d.attempt", "_d.delivered_at"))


def acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    early = F.col("timestamp") < instant("2024-01-05 00:00:00")
    later = (F.col("timestamp") < instant("2024-01-20 00:00:00")) & (k_of() != 13)
    return split_log(spark, sf_dir).where(early | later).select("split_id", "stream_seq")


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits have read up to 2024-01-12; `view` is paused, `signup` has not started."""
    before = F.col("timestamp") < instant("2024-01-12 00:00:00")
    return (split_log(spark, sf_dir).where(F.col("filter") != "events.signup.>")
            .groupBy("split_id", "filter")
            .agg(F.max(F.when(before, F.col("stream_seq"))).alias("last_seq"))
            .select("split_id", "last_seq",
                    F.when(F.col("filter") == "events.view.>", "paused").otherwise("active").alias("status")))


# So many payloads are coded at a time.
CODED_ROWS = 256


def compressing():
    """A custom encoder and its decoder, exchanged in Arrow batches, which Spark bounds in bytes. Payloads are coded
    out of the batch's own buffers and handed back a few at a time, so a task holds no copy of a batch in Python.
    NULL stays NULL. Local functions travel to executors by value."""
    rows = CODED_ROWS

    def coded(code, batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for first in range(0, len(batch), rows):
                buffers = (value.as_buffer() for value in batch[first:first + rows])
                yield pa.array((None if buffer is None else code(buffer) for buffer in buffers), pa.binary())

    @F.arrow_udf(T.BinaryType())
    def deflate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return coded(zlib.compress, batches)

    @F.arrow_udf(T.StringType())
    def inflate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return (part.cast(pa.string()) for part in coded(zlib.decompress, batches))

    return deflate, inflate
