"""Flow statistics as queries and as observed metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

N_BYTES = F.octet_length


def stream_info(log: DataFrame) -> DataFrame:
    """Per stream: number of messages, first and last sequence, number of subjects."""
    # Subjects first: the distinct count then works on one row per subject and stream.
    subjects = log.groupBy("stream", "subject").agg(
        F.count(F.lit(1)).alias("n"), F.min("stream_seq").alias("first"), F.max("stream_seq").alias("last"))
    return subjects.groupBy("stream").agg(
        F.sum("n").alias("n_messages"), F.min("first").alias("first_seq"),
        F.max("last").alias("last_seq"), F.count(F.lit(1)).alias("n_subjects"))


def flow_in(read: DataFrame, by: Sequence[str] = ("stream",)) -> DataFrame:
    """Records, bytes and consumers of a read."""
    per_split = read.groupBy(*by, "split_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(N_BYTES("data")).alias("b"))
    return per_split.groupBy(*by).agg(
        F.sum("n").alias("n_records"), F.sum("b").alias("n_bytes"), F.count(F.lit(1)).alias("n_consumers"))


def flow_out(results: DataFrame) -> DataFrame:
    """Records and bytes per publish outcome."""
    return results.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_records"), F.coalesce(F.sum(N_BYTES("data")), F.lit(0)).alias("n_bytes"))


def flow_sizes(log: DataFrame, by: Sequence[str]) -> DataFrame:
    size = N_BYTES("data")
    return log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_records"), F.min(size).alias("min_bytes"),
        F.max(size).alias("max_bytes"), F.avg(size).alias("avg_bytes"))


def observed(frame: DataFrame, observation: Observation | str = "read") -> DataFrame:
    """Count records and bytes while the frame is used, without a second pass. A streaming
    query reports them in ``observedMetrics`` of its progress."""
    return frame.observe(observation, F.count(F.lit(1)).alias("n_records"),
                         F.sum(N_BYTES("data")).alias("n_bytes"))


def last_per_subject(log: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The newest message of every subject of every stream; NULL is a subject like any other.

    Each task keeps one message per subject, and only those are shuffled.
    """
    row = F.max_by(F.struct("stream_seq", *columns), "stream_seq").alias("_row")
    return log.groupBy("stream", "subject").agg(row).select("stream", "subject", "_row.*")


def last_message(log: DataFrame) -> DataFrame:
    """The newest message of the log."""
    return log.where(F.col("stream_seq") == log.agg(F.max("stream_seq").alias("last")).scalar())
