"""Ordinary tables read as logs: each row becomes one message envelope.

The expressions are lazy, so a read that needs no headers or payload never builds
them. The columns that hold subject tokens are kept, with their positions, so that
subject filters reach the scan of the underlying table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msglog.schema import HEADERS

EVENT_TOKENS = {1: ("event_type", "string"), 2: ("user_id", "bigint")}
EVENT_SEQ = ("event_id", 1)
ORDER_TOKENS = {1: ("o_orderstatus", "string")}
DOCUMENT_TOKENS = {1: ("lang", "string"), 2: ("source", "string")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_log(rows: DataFrame, stream: str, subject: Column, seq: Column, timestamp: Column,
           data: Column, headers: Column | None = None, msg_id: Column | None = None,
           keep: tuple[str, ...] = ()) -> DataFrame:
    return rows.select(
        F.lit(stream).alias("stream"), subject.alias("subject"),
        (F.lit(None) if headers is None else headers).cast(HEADERS).alias("headers"),
        data.alias("data"), seq.cast("long").alias("stream_seq"), timestamp.alias("timestamp"),
        F.lit("UTC").alias("timezone"), F.lit(None).cast("string").alias("domain"),
        (F.lit(None) if msg_id is None else msg_id).cast("string").alias("msg_id"),
        *keep,
    )


def events_as_log(rows: DataFrame) -> DataFrame:
    """``events.<event_type>.<user_id>``, payload ``props``; works on batch and stream."""
    return as_log(
        rows, "events",
        subject=F.concat_ws(".", F.lit("events"), "event_type", F.col("user_id").cast("string")),
        seq=F.col("event_id") + 1,
        timestamp=F.col("ts"),
        data=F.encode("props", "UTF-8"),
        headers=F.create_map(F.lit("event-type"), F.array("event_type"),
                             F.lit("user"), F.array(F.col("user_id").cast("string"))),
        msg_id=F.col("event_id").cast("string"),
        keep=("event_type", "user_id", "event_id"),
    )


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_log(table(spark, sf_dir, "events"))


def events_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The events table as an unbounded log (a file or a directory of files)."""
    reader = spark.readStream.schema(table(spark, sf_dir, "events").schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return events_as_log(reader.parquet(f"{sf_dir}/[e]vents.parquet"))


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders.<status>.<priority digit>``, payload the order as JSON."""
    rows = table(spark, sf_dir, "orders")
    return as_log(
        rows, "orders",
        subject=F.concat_ws(".", F.lit("orders"), "o_orderstatus", F.substring("o_orderpriority", 1, 1)),
        seq=F.col("o_orderkey") + 1,
        timestamp=F.col("o_orderdate"),
        data=F.encode(F.to_json(F.struct("o_orderkey", "o_custkey", "o_totalprice")), "UTF-8"),
        msg_id=F.col("o_orderkey").cast("string"),
        keep=("o_orderstatus",),
    )


def documents_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``docs.<lang>.<source>``, payload the whole text."""
    rows = table(spark, sf_dir, "documents")
    return as_log(
        rows, "docs",
        subject=F.concat_ws(".", F.lit("docs"), "lang", "source"),
        seq=F.col("doc_id") + 1,
        timestamp=F.lit(None).cast("timestamp"),
        data=F.encode("text", "UTF-8"),
        msg_id=F.md5("text"),
        keep=("lang", "source"),
    )
