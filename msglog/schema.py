"""The message envelope: the contract every operator reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

HEADERS = T.MapType(T.StringType(), T.ArrayType(T.StringType()))

# A stored log: one row per message.
ENVELOPE = T.StructType([
    T.StructField("subject", T.StringType()),
    T.StructField("headers", HEADERS),
    T.StructField("data", T.BinaryType()),
    T.StructField("stream_seq", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("msg_id", T.StringType()),
    T.StructField("stream", T.StringType()),
])

# Metadata a reader may ask for, by public name, and the column that holds it.
READABLE = {
    "headers": "headers",
    "subject": "subject",
    "stream": "stream",
    "consumer": "consumer",
    "domain": "domain",
    "delivered": "delivered",
    "streamSeq": "stream_seq",
    "consumerSeq": "consumer_seq",
    "pending": "pending",
    "timestamp": "timestamp",
    "timezone": "timezone",
}

# Metadata a writer may set.
WRITABLE = ("headers", "subject")

DELIVERIES = T.StructType([
    T.StructField("split_id", T.StringType()),
    T.StructField("stream_seq", T.LongType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("delivered_at", T.TimestampType()),
])

ACKS = T.StructType([
    T.StructField("split_id", T.StringType()),
    T.StructField("stream_seq", T.LongType()),
    T.StructField("acked_at", T.TimestampType()),
])

PROGRESS = T.StructType([
    T.StructField("split_id", T.StringType()),
    T.StructField("last_seq", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("epoch", T.LongType()),
])

# Stored logs are partitioned by blocks of this many sequence numbers.
BLOCK = 1 << 26
BLOCK_COLUMN = "seq_block"

# Rows of a batch with a number carry it, and their place in the staged batch. Reads do not see these columns.
BATCH = "batch_id"
BATCH_ROW = "batch_row"
