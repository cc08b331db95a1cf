"""Consumption progress, acknowledgement and redelivery as table operators.

Inputs are ``deliveries(split_id, stream_seq, attempt, delivered_at)``,
``acks(split_id, stream_seq, acked_at)`` and ``progress(split_id, last_seq, status)``.
Aggregates per split hold one row per filter of the read; pass ``n_splits`` where that
number is known, so the join back to the deliveries needs no shuffle of a hot split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msglog.operators.positions import SeqColumn
from msglog.operators.splits import hinted

KEYS = ["split_id", "stream_seq"]


def acked_explicit(deliveries: DataFrame, acks: DataFrame) -> DataFrame:
    """Delivered messages that were acknowledged one by one."""
    return deliveries.join(acks.select(*KEYS), KEYS, "left_semi")


def pending_explicit(deliveries: DataFrame, acks: DataFrame) -> DataFrame:
    """Delivered messages without an acknowledgement of their own."""
    return deliveries.join(acks.select(*KEYS), KEYS, "left_anti")


def _highest_ack(acks: DataFrame, n_splits: int | None) -> DataFrame:
    return hinted(acks.groupBy("split_id").agg(F.max("stream_seq").alias("_acked")), n_splits)


def acked_cumulative(deliveries: DataFrame, acks: DataFrame, n_splits: int | None = None) -> DataFrame:
    """An acknowledgement covers every earlier message of its split."""
    return (deliveries.join(_highest_ack(acks, n_splits), "split_id")
            .where(F.col("stream_seq") <= F.col("_acked")).drop("_acked"))


def pending_cumulative(deliveries: DataFrame, acks: DataFrame, n_splits: int | None = None) -> DataFrame:
    return (deliveries.join(_highest_ack(acks, n_splits), "split_id", "left")
            .where(F.col("_acked").isNull() | (F.col("stream_seq") > F.col("_acked"))).drop("_acked"))


def acked_none(deliveries: DataFrame) -> DataFrame:
    """Without acknowledgements every delivered message counts as done."""
    return deliveries


def pending(deliveries: DataFrame, acks: DataFrame, ack: str = "each", n_splits: int | None = None) -> DataFrame:
    """Outstanding deliveries under an ack policy: ``each``, ``all`` or ``none``."""
    if ack == "each":
        return pending_explicit(deliveries, acks)
    if ack == "all":
        return pending_cumulative(deliveries, acks, n_splits)
    if ack == "none":
        return deliveries.where(F.lit(False))
    raise ValueError(f"ack policy must be 'each', 'all' or 'none', got {ack!r}")


def unacknowledged(read: DataFrame, acks: DataFrame, ack: str) -> DataFrame:
    """A read without what was acknowledged before: one by one (``each``), or everything up to
    the highest acknowledged message of a split (``all``)."""
    if ack == "each":
        return read.join(acks.select(*KEYS).distinct(), KEYS, "left_anti")
    return pending_cumulative(read, acks).select(*read.columns)


def floors(deliveries: DataFrame, acks: DataFrame, n_splits: int | None = None) -> DataFrame:
    """``(split_id, ack_floor, delivered_floor)``: the last message below which nothing is
    outstanding, and the last one delivered."""
    unacked = (pending_explicit(deliveries.select(*KEYS), acks)
               .groupBy("split_id").agg(F.min("stream_seq").alias("_first_open")))
    below = F.col("_first_open").isNull() | (F.col("stream_seq") < F.col("_first_open"))
    return (deliveries.select(*KEYS).join(hinted(unacked, n_splits), "split_id", "left")
            .groupBy("split_id")
            .agg(F.coalesce(F.max(F.when(below, F.col("stream_seq"))), F.lit(0)).alias("ack_floor"),
                 F.max("stream_seq").alias("delivered_floor")))


def delivered_count(deliveries: DataFrame) -> DataFrame:
    """Delivery attempts per message of a split."""
    return deliveries.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("delivered"))


def with_attempt(read: DataFrame, deliveries: DataFrame | None = None) -> DataFrame:
    """Add ``delivered``, the number of the present delivery: one more than the past ones of the
    same message and split."""
    if deliveries is None:
        return read.withColumn("delivered", F.lit(1).cast("long"))
    past = delivered_count(deliveries).withColumnRenamed("delivered", "_past")
    return (read.join(past, KEYS, "left")
            .withColumn("delivered", (F.coalesce("_past", F.lit(0)) + 1).cast("long")).drop("_past"))


def redeliver(deliveries: DataFrame, acks: DataFrame, now: Column, ack_wait: str,
              max_deliver: int | None = None) -> DataFrame:
    """Messages due again at ``now``: unacknowledged, last delivered at least ``ack_wait`` ago
    and, where ``max_deliver`` is set, with attempts left. ``attempt`` is the coming one."""
    last = (deliveries.groupBy(*KEYS)
            .agg(F.max("attempt").alias("_attempt"), F.max("delivered_at").alias("_at")))
    due = F.col("_at") + F.expr(f"INTERVAL {ack_wait}") <= now
    if max_deliver is not None:
        due = due & (F.col("_attempt") < max_deliver)
    return (last.join(acks.select(*KEYS), KEYS, "left_anti").where(due)
            .select(*KEYS, (F.col("_attempt") + 1).cast("int").alias("attempt")))


def resume(matched: DataFrame, progress: DataFrame, splits: DataFrame | None = None,
           n_splits: int | None = None, seq: SeqColumn | None = None) -> DataFrame:
    """Messages of each active split after its last sequence. A split without progress starts
    from the beginning; a paused one keeps its place and delivers nothing.

    With ``splits``, the split ids of the read, of which there are ``n_splits``, the part of the
    log that every active split has behind it is not scanned again.
    """
    state = progress.select("split_id", "last_seq", "status")
    active = F.coalesce("status", F.lit("active")) == "active"
    last = F.coalesce("last_seq", F.lit(0))
    if splits is not None:
        column, offset = seq or ("stream_seq", 0)
        # At most one row per split of the read, whatever else the progress table holds.
        state = splits.select("split_id").join(state, "split_id", "left")
        behind = state.where(active).agg((F.min(last) - offset).alias("behind"))
        matched = matched.where(F.col(column) > behind.scalar())
        state = hinted(state, n_splits)
    return (matched.join(state, "split_id", "left")
            .where(active & (F.col("stream_seq") > last))
            .drop("last_seq", "status"))


def set_status(progress: DataFrame, pause: tuple[str, ...] = (), resume: tuple[str, ...] = ()) -> DataFrame:
    """Pause and resume splits; the last sequence of a split does not change."""
    status = (F.when(F.col("split_id").isin(list(pause)), F.lit("paused"))
              .when(F.col("split_id").isin(list(resume)), F.lit("active"))
              .otherwise(F.col("status")))
    return progress.withColumn("status", status)


def update_progress(progress: DataFrame, batch: DataFrame) -> DataFrame:
    """Progress after a batch; splits without rows in it stay as they were."""
    seen = batch.groupBy("split_id").agg(F.max("stream_seq").alias("_seen"))
    return (progress.select("split_id", "last_seq", "status").join(seen, "split_id", "full_outer")
            .select("split_id",
                    F.greatest("last_seq", "_seen").alias("last_seq"),
                    F.coalesce("status", F.lit("active")).alias("status")))


def completed_progress(history: DataFrame, last_completed: int) -> DataFrame:
    """Progress from a history keyed by epoch: a completed epoch covers all earlier ones,
    later ones do not count yet."""
    return (history.where(F.col("epoch") <= last_completed)
            .groupBy("split_id").agg(F.max("last_seq").alias("last_seq")))


def pending_count(deliveries: DataFrame, acks: DataFrame, ack: str = "each",
                  n_splits: int | None = None) -> DataFrame:
    """Messages delivered but not acknowledged, per split (zero where all are)."""
    open_ = (pending(deliveries, acks, ack, n_splits)
             .groupBy("split_id").agg(F.count_distinct("stream_seq").alias("_n")))
    splits = deliveries.select("split_id").distinct()
    return splits.join(open_, "split_id", "left").select("split_id", F.coalesce("_n", F.lit(0)).alias("ack_pending"))
