"""Redelivery in a stream: messages whose acknowledgement does not come in time are due again."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

KEYS = ["split_id", "stream_seq"]
# The messages of a split whose sequences agree above so many bits share a state, a timer and a call.
SPAN_BITS = 12
_MESSAGE = {"place": "int32", "attempt": "int32", "at_ms": "int64", "acked": "bool"}


class _Waiting(StatefulProcessor):
    """The messages of a split in one span of sequences: of each its last attempt and when that was, until it is
    acknowledged. A message is due one wait after that: for its next attempt or, once acknowledged, to be forgotten,
    as nothing more is expected of it. The timer of a span is the time when the first of its messages is due."""

    def __init__(self, wait_ms: int, max_deliver: int | None):
        self.wait_ms, self.max_deliver = wait_ms, max_deliver

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("messages", "place ARRAY<INT>, attempt ARRAY<INT>, at_ms ARRAY<LONG>, acked ARRAY<BOOLEAN>")

    def _read(self) -> pd.DataFrame:
        known = self.state.get() or [[] for _ in _MESSAGE]
        return pd.DataFrame(dict(zip(_MESSAGE, known))).astype(_MESSAGE)

    def _write(self, messages: pd.DataFrame) -> None:
        if len(messages):
            self.state.update(tuple(messages[column].tolist() for column in _MESSAGE))
        else:
            self.state.clear()

    def _due(self, messages: pd.DataFrame) -> pd.Series:
        """When messages are due; those without attempts left never are."""
        due = messages["at_ms"] + self.wait_ms
        return due if self.max_deliver is None else due[messages["acked"] | (messages["attempt"] < self.max_deliver)]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self._read()
        told = [part[[*_MESSAGE]].groupby("place", as_index=False).max() for part in rows]
        messages = pd.concat([known, *told]).groupby("place", as_index=False).max()
        messages[["attempt", "at_ms"]] = messages[["attempt", "at_ms"]].clip(lower=0)
        messages = messages.astype(_MESSAGE)
        messages = messages[messages["acked"] | (messages["attempt"] > 0)]
        before, after = self._due(known), self._due(messages)
        if len(before):
            self.handle.deleteTimer(int(before.min()))
        if len(after):
            self.handle.registerTimer(int(after.min()))
        self._write(messages)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        messages = self._read()
        due = self._due(messages)
        due = due[due <= timerValues.getCurrentWatermarkInMs()]
        acked = messages.loc[due.index, "acked"]
        again = due[~acked]
        messages.loc[again.index, "attempt"] += 1
        messages.loc[again.index, "at_ms"] = again
        told = messages.loc[again.index, ["place", "attempt"]].assign(split_id=key[0], span=key[1], due_ms=again)
        messages = messages.drop(acked.index[acked])
        later = self._due(messages)
        later = later[later > expiredTimerInfo.getExpiryTimeInMs()]  # Spark drops the timer that has expired after this call
        if len(later):
            self.handle.registerTimer(int(later.min()))
        self._write(messages)
        return iter([told] if len(told) else [])

    def close(self) -> None:
        pass


def redeliver_stream(deliveries: DataFrame, acks: DataFrame, ack_wait: str, max_deliver: int | None = None,
                     delay: str = "0 seconds") -> DataFrame:
    """``(split_id, stream_seq, attempt, due_at)`` of messages that are due again: not acknowledged within
    ``ack_wait`` of their last delivery and, where ``max_deliver`` is set, with attempts left.

    ``deliveries(split_id, stream_seq, attempt, delivered_at)`` and ``acks(split_id, stream_seq, acked_at)`` are
    streams. Time is that of their rows; ``delay`` is how much later than others a row may come. What is
    due counts as delivered at its time and comes again one ``ack_wait`` later. State is keyed by split and span of
    2¹² sequences and survives restarts; that of a message goes one ``ack_wait`` after its acknowledgement, that of
    a message without attempts left stays. A delivery of attempt 0 only moves the time.

    Start the query with ``flows.drain`` or with a RocksDB state store; with the batch rule
    (:func:`msglog.operators.progress.redeliver`) at the time of the watermark it agrees for the first due attempt.
    """
    time = lambda column: F.col(column).cast("timestamp")
    rows = deliveries.select(*KEYS, F.col("attempt").cast("int").alias("attempt"), time("delivered_at").alias("at"), F.lit(False).alias("acked")) \
        .unionByName(acks.select(*KEYS, F.lit(0).alias("attempt"), time("acked_at").alias("at"), F.lit(True).alias("acked"))) \
        .withWatermark("at", delay).withColumn("at_ms", F.unix_millis("at"))
    wait = rows.sparkSession.range(1).select(F.expr(f"unix_millis(timestamp_millis(0) + INTERVAL {ack_wait})")).first()[0]
    spans = rows.select("split_id", F.coalesce(F.shiftright("stream_seq", SPAN_BITS), F.lit(0)).alias("span"),
                        F.coalesce(F.col("stream_seq").bitwiseAND((1 << SPAN_BITS) - 1).cast("int"), F.lit(-1)).alias("place"),
                        "attempt", "at", "at_ms", "acked")  # a sequence that is NULL has place -1
    due = spans.groupBy("split_id", "span").transformWithStateInPandas(
        _Waiting(wait, max_deliver), "split_id STRING, span LONG, place INT, attempt INT, due_ms LONG", "Append", "EventTime")
    seq = F.when(F.col("place") >= 0, F.shiftleft("span", SPAN_BITS) + F.col("place"))
    return due.select("split_id", seq.alias("stream_seq"), "attempt", F.timestamp_millis("due_ms").alias("due_at"))
