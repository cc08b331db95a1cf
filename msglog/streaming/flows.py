"""Streaming reads and writes with Structured Streaming.

Spark's checkpoint holds the read position; a restarted query continues where its
last committed batch ended. A batch that is replayed after a failure is known by its
number, so ``publish`` stores it once, with message ids or without.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from msglog.functions.metadata import event_time
from msglog.functions.subjects import TokenColumns
from msglog.operators.positions import at_millis
from msglog.operators.publish import PublishResult, forget_batch, live, publish
from msglog.operators.splits import FilterSet, match_filters, match_splits, with_split
from msglog.operators.stats import flow_out
from msglog.sources.store import discard, list_folder, mark, marked, saved

# What is kept of so many batches of a query; Spark replays none but the last.
KEPT_BATCHES = 100
_TIME = "_time_"


@contextmanager
def _settings(stream: DataFrame) -> Iterator[None]:
    """The session as a stream needs it while its query starts, which keeps what it finds: several event times in
    one scan (:func:`split_watermarks`), and state with timers."""
    spark, plan = stream.sparkSession, stream._jdf.queryExecution().analyzed().toString()
    wanted = {}
    if f"{_TIME}0" in plan:
        wanted["spark.sql.streaming.statefulOperator.allowMultiple"] = "false"
    if "TransformWithState" in plan:
        wanted["spark.sql.streaming.stateStore.providerClass"] = \
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def drain(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything available now to Parquet, then stop."""
    with _settings(stream):
        query = (stream.writeStream.format("parquet").outputMode("append")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path))
    query.awaitTermination()
    return query


def with_watermark(log: DataFrame, delay: str) -> DataFrame:
    """Event time in milliseconds with a watermark, placed right after the scan."""
    return log.withColumn("event_time", event_time(F.col("timestamp"))).withWatermark("event_time", delay)


def split_watermarks(log: DataFrame | Callable[[], DataFrame], filters: Sequence[str], delay: str,
                     tokens: TokenColumns | None = None) -> DataFrame:
    """One watermark per split, in one scan: every filter has an event time of its own, which is NULL in the rows
    of others, and the watermark of the read is the least of theirs. A filter that has delivered nothing
    yet holds the watermark back. A message that several filters match comes once for each.

    Start the query with :func:`drain`, :func:`consume` or :func:`publish_stream`; Spark takes several event
    times in a row only where ``spark.sql.streaming.statefulOperator.allowMultiple`` is false, and then
    one stateful operator after them."""
    source = log() if callable(log) else log
    matched = match_filters(source, FilterSet.of(source.sparkSession, list(filters)), tokens=tokens)
    matched = matched.withColumn("event_time", event_time(F.col("timestamp")))
    own = {f"{_TIME}{i}": F.when(F.col("filter") == f, F.col("event_time")) for i, f in enumerate(dict.fromkeys(filters))}
    matched = matched.withColumns(own)
    for name in own:
        matched = matched.withWatermark(name, delay)
    return matched.withWatermark("event_time", delay).drop(*own)


def dedupe_stream(log: DataFrame, delay: str | None = None) -> DataFrame:
    """Drop repeated message ids with keyed state.

    Without ``delay`` every id is remembered. With it, ids are forgotten once the watermark
    has passed them by ``delay``; messages later than the watermark are then dropped as well,
    so use it only on logs read in time order.
    """
    if delay is None:
        return log.dropDuplicates(["stream", "msg_id"])
    return with_watermark(log, delay).dropDuplicatesWithinWatermark(["stream", "msg_id"])


# What a consuming query knows: where it has passed each stream (``filter`` is NULL), and up to where each filter
# has read it.
STATE = "stream STRING, filter STRING, last_seq LONG, status STRING, epoch LONG"
KEPT_STATES = 2


def _states(spark: SparkSession, checkpoint: str) -> list[str]:
    return [f for f in list_folder(spark, f"{checkpoint}-state") if marked(spark, f, "_done")]


def _state(spark: SparkSession, checkpoint: str, before: int | None = None) -> DataFrame:
    """The newest state, or the newest one before an epoch."""
    known = [f for f in _states(spark, checkpoint) if before is None or int(os.path.basename(f)) < before]
    return spark.read.schema(STATE).parquet(known[-1]) if known else spark.createDataFrame([], STATE)


def consumed(spark: SparkSession, checkpoint: str, prefix: str = "consumer") -> DataFrame:
    """Progress ``(split_id, last_seq, status, epoch)`` that a query started by ``consume`` has committed. All that
    was delivered up to ``last_seq`` of a split has been handled."""
    splits = _state(spark, checkpoint).where(F.col("filter").isNotNull())
    return with_split(splits, prefix).select("split_id", "last_seq", "status", "epoch")


def consume(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
            registry: Callable[[SparkSession], DataFrame], prefix: str = "consumer",
            tokens: TokenColumns | None = None, interval: str | None = None,
            stored: Callable[[SparkSession], DataFrame] | None = None,
            start: tuple = ("earliest",), catch_up: bool = True) -> StreamingQuery:
    """Hand every micro-batch, with ``filter``, ``consumer`` and ``split_id``, to ``handle``.

    The ``registry`` of filters, of one stream or all, is read again for each batch: a filter that
    was added is read from then on, one that was withdrawn, or whose ``status`` is ``paused``, delivers
    nothing more.

    With the ``stored`` log, the position of every filter in every stream is committed after each batch that
    ``handle`` returned from, and a filter that is behind the query - because it is new, was paused, or
    was withdrawn and is there again - first delivers what it missed, a new one from the position of
    ``start`` on. Without ``catch_up`` such a filter skips what the query has passed. A batch that
    failed is handed over again with the same rows, so no filter loses or repeats a message across
    restarts. The state is one small file; :func:`consumed` reads it as progress.
    """
    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        current = live(registry(spark))
        columns = [c for c in ("stream", "filter") if c in current.columns]
        status = F.coalesce("status", F.lit("active")) if "status" in current.columns else F.lit("active")
        current = current.select(*columns, status.alias("status")).distinct()
        if stored is None:
            active = current.where(F.col("status") == "active").drop("status")
            handle(match_splits(batch, FilterSet.of(spark, active), prefix, tokens=tokens), epoch)
            return
        past = _state(spark, checkpoint, epoch)
        passed = past.where(F.col("filter").isNull()).select("stream", F.col("last_seq").alias("_passed"))
        ends = batch.groupBy("stream").agg(F.max("stream_seq").alias("_end")).join(passed, "stream", "full_outer") \
            .select("stream", F.greatest("_end", "_passed").alias("_end"), F.coalesce("_passed", F.lit(0)).alias("_passed"))
        ends = saved(ends, "ends")
        if "stream" not in columns:  # a filter of all streams has a position in each
            streams = [r.stream for r in ends.select("stream").collect()]
            current = current.withColumn("stream", F.explode(F.array(*map(F.lit, streams)).cast("array<string>")))
        read = past.where(F.col("filter").isNotNull()).select("stream", "filter", F.col("last_seq").alias("_last"),
                                                              F.col("status").alias("_was"))
        known = current.join(read, ["stream", "filter"], "full_outer").join(ends, "stream", "left") \
            .withColumn("status", F.coalesce("status", F.lit("withdrawn")))
        idle = F.col("_last").isNull() | (F.col("_was") != "active")
        last = F.coalesce("_last", F.lit(0)) if catch_up else F.when(idle, F.col("_passed")).otherwise(F.col("_last"))
        known = saved(known.select("stream", "filter", "status", F.coalesce(last, F.lit(0)).alias("_last"),
                                   F.col("_last").isNull().alias("_new"), "_end", "_passed"), "splits")
        active = known.where((F.col("status") == "active") & F.col("_end").isNotNull())
        now = active.select("stream", "filter", "_last")
        out = match_splits(batch, FilterSet.of(spark, now), prefix, tokens=tokens).where(F.col("stream_seq") > F.col("_last"))
        behind = active.where(F.col("_last") < F.col("_passed")).select("stream", "filter", "_last", "_passed", "_new")
        log = stored(spark)
        if start[0] == "time":
            log = log.withColumn("_from", F.col("timestamp") >= at_millis(log, "timestamp", start[1]))
        else:
            first = {"earliest": 0, "latest": (1 << 63) - 1}.get(start[0], start[-1])
            log = log.withColumn("_from", F.col("stream_seq") >= first)
        low = behind.agg(F.coalesce(F.min("_last"), F.max("_passed"), F.lit((1 << 63) - 1))).first()[0]
        missed = match_splits(log.where(F.col("stream_seq") > low), FilterSet.of(spark, behind), prefix, tokens=tokens)
        missed = missed.where((F.col("stream_seq") > F.col("_last")) & (F.col("stream_seq") <= F.col("_passed"))
                              & (~F.col("_new") | F.col("_from")))
        handle(missed.select(*out.columns).drop("_last").unionByName(out.drop("_last")), epoch)
        done = F.when((F.col("status") == "active") & F.col("_end").isNotNull(), F.col("_end")).otherwise(F.col("_last"))
        after = known.select("stream", "filter", done.alias("last_seq"), "status") \
            .unionByName(ends.select("stream", F.lit(None).cast("string").alias("filter"), F.col("_end").alias("last_seq"),
                                     F.lit(None).cast("string").alias("status")))
        folder = f"{checkpoint}-state/{epoch:012d}"
        after.withColumn("epoch", F.lit(epoch).cast("long")).coalesce(1).write.mode("overwrite").parquet(folder)
        mark(spark, folder, "_done")
        for old in _states(spark, checkpoint)[:-KEPT_STATES]:
            discard(spark, old)

    return _run(stream, step, checkpoint, interval)


def _run(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str,
         interval: str | None) -> StreamingQuery:
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    with _settings(stream):
        return (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
                .trigger(**trigger).start())


def publish_stream(stream: DataFrame, path: str, registry: Callable[[SparkSession], DataFrame],
                   checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None,
                   interval: str | None = None, metrics: str | None = None, **options) -> StreamingQuery:
    """Publish every micro-batch. ``registry`` is read again for each batch, so new streams
    and filters take effect while the query runs. Without ``interval`` the query handles
    what is available and stops. ``metrics`` is a folder that gets the outcome of every batch
    (:func:`flow_metrics`)."""

    query = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def write(batch: DataFrame, epoch: int) -> None:
        messages = prepare(batch) if prepare else batch
        result = publish(messages, path, registry(batch.sparkSession), batch_id=f"{query}-{epoch:012d}", **options)
        if metrics:
            _measure(result, metrics, query, epoch)
        result.discard()
        if epoch >= KEPT_BATCHES:
            forget_batch(batch.sparkSession, path, f"{query}-{epoch - KEPT_BATCHES:012d}")

    return _run(stream, write, checkpoint, interval)


_METRICS = "query STRING, epoch LONG, status STRING, n_records LONG, n_bytes LONG"
MERGED_EPOCHS = 64


def _measure(result: PublishResult, folder: str, query: str, epoch: int) -> None:
    """Outcome of one batch. A batch that is replayed replaces its rows, unless the replay found all of it stored:
    then the rows are there already, or the batch died between its append and its measure, which is
    measured as what the replay did."""
    spark = result.messages.sparkSession
    place = f"{folder}/{query}-{epoch:012d}"
    if marked(spark, place, "_done"):
        return
    rows = flow_out(result.messages).select(F.lit(query).alias("query"), F.lit(epoch).cast("long").alias("epoch"), "status", "n_records", "n_bytes")
    rows.coalesce(1).write.mode("overwrite").parquet(place)
    mark(spark, place, "_done")
    if (epoch + 1) % MERGED_EPOCHS == 0:  # older batches as one file
        own = [f for f in list_folder(spark, folder) if os.path.basename(f).startswith(query) and marked(spark, f, "_done")]
        spark.read.schema(_METRICS).parquet(*own).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{query}-{epoch:012d}-all")
        mark(spark, f"{folder}/{query}-{epoch:012d}-all", "_done")
        for old in own:
            discard(spark, old)


def flow_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """``(query, epoch, status, n_records, n_bytes)`` of the batches that publishing queries have measured."""
    done = [f for f in list_folder(spark, folder) if marked(spark, f, "_done")]
    rows = spark.read.schema(_METRICS).parquet(*done) if done else spark.createDataFrame([], _METRICS)
    return rows.distinct()  # a merge that died before it removed the old files
