"""Publishing: rows to messages, messages to a stored log.

``outgoing`` turns rows into messages, ``capture`` finds the stream that stores each
subject, ``mark_status`` tells stored, duplicate and rejected messages apart, and
``publish`` runs all of it and appends. Everything but ``publish`` is lazy.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msglog.functions import headers as H
from msglog.functions import payload as P
from msglog.functions.subjects import is_valid_subject
from msglog.operators.sequence import MAX_SPANS, SPAN_BITS, dense_seq, in_span, marked_spans
from msglog.operators.splits import BROADCAST_ROWS, FilterSet, first_capture, hinted, union_all
from msglog.schema import BATCH, BATCH_ROW, ENVELOPE, HEADERS, WRITABLE
from msglog.sources import side
from msglog.sources.side import known_ids
from msglog.sources.store import (append_log, discard, log_exists, mark, marked, open_log, past_heads, record_heads, saved,
                                  shared_dir, stream_heads)

# Folders of batches; names starting with '_' are skipped when the directory is read as a log.
BATCHES = "_batches"
OK, DUPLICATE, FAILED = "ok", "duplicate", "failed"
# So many rows a writer sorts at most, where their number is given; a larger batch is appended in parts.
WRITER_ROWS = 1 << 20
# Rows of a staged file are addressed in so many low bits, without gaps.
ROW_BITS = 33


class CaptureError(ValueError):
    """A message has a subject that no stream stores."""


def route(rows: DataFrame, subject: str | None = None, by: Column | None = None) -> DataFrame:
    """Give every row its subject: a static one wins, then a function of the row, then the
    row's own ``subject`` column."""
    if subject is not None:
        return rows.withColumn("subject", F.lit(subject))
    if by is not None:
        return rows.withColumn("subject", by)
    if "subject" not in rows.columns:
        raise ValueError("no subject: give a static subject, a routing column, or a 'subject' column")
    return rows


def hash_subject(prefix: str, key: Column, n: int) -> Column:
    """Spread records over ``n`` subjects below a prefix by an integer key."""
    return F.concat(F.lit(prefix + "."), F.pmod(key, F.lit(n)).cast("string"))


def outgoing(rows: DataFrame, *, subject: str | None = None, by: Column | None = None,
             format: P.Codec = "json", columns: Sequence[str] | Column | None = None,
             msg_id: Column | None = None, timestamp: Column | None = None,
             event_time: Column | None = None, event_time_header: str = H.EVENT_TIME_HEADER,
             timezone: str = "UTC", domain: str | None = None,
             keep: Sequence[str] = ()) -> DataFrame:
    """Rows as messages. The payload holds the physical columns only: all but the writable
    metadata, unless ``columns`` says otherwise. ``event_time`` adds the event-time header."""
    routed = route(rows, subject, by)
    physical = columns if columns is not None else [c for c in rows.columns if c not in WRITABLE]
    stored = H.writable(F.col("headers")) if "headers" in rows.columns else H.empty()
    if event_time is not None:
        stored = H.with_event_time(stored, event_time, event_time_header)
    return routed.select(
        F.col("subject").cast("string").alias("subject"),
        stored.cast(HEADERS).alias("headers"),
        P.encoded(format, physical).alias("data"),
        (F.current_timestamp() if timestamp is None else timestamp).cast("timestamp").alias("timestamp"),
        F.lit(timezone).alias("timezone"),
        F.lit(domain).cast("string").alias("domain"),
        (F.lit(None) if msg_id is None else msg_id).cast("string").alias("msg_id"),
        *keep,
    )


def live(registry: DataFrame) -> DataFrame:
    """The entries of a registry that are in force."""
    return registry.where(F.col("to_seq").isNull()) if "to_seq" in registry.columns else registry


def capture(messages: DataFrame, registry: DataFrame) -> DataFrame:
    """Add the ``stream`` that stores each message; NULL where none does."""
    return _capture(messages, FilterSet.of(messages.sparkSession, live(registry).select("filter", "stream")))


def _capture(messages: DataFrame, filters: FilterSet) -> DataFrame:
    found = first_capture(messages, filters, "stream")
    return found.withColumn("stream", F.when(is_valid_subject(F.col("subject")), F.col("stream")))


def rejected(captured: DataFrame) -> DataFrame:
    return captured.where(F.col("stream").isNull())


def mark_status(captured: DataFrame, order: str, known: DataFrame | None = None,
                n_rows: int | None = None) -> DataFrame:
    """Add ``status``: ``failed`` without a stream, ``duplicate`` if the message id was stored
    before or comes earlier in ``order`` (a unique column), else ``ok``. Messages without an
    id are never duplicates."""
    found = union_all(_duplicates(captured, order, known, n_rows)).distinct().withColumn("_copy", F.lit(True))
    status = F.when(F.col("stream").isNull(), FAILED).when(F.col("_copy"), DUPLICATE).otherwise(OK)
    return (captured.join(hinted(found, n_rows), order, "left").withColumn("status", status)
            .select(*captured.columns, "status"))


def _duplicates(batch: DataFrame, order: str, known: DataFrame | None, n_ids: int | None,
                stage: str | None = None) -> list[DataFrame]:
    """The ``order`` of messages whose id comes earlier in the batch or is among the ``known`` ones. Copies of an
    id are reduced to their first before anything is shuffled. ``n_ids``: the ids of the batch, where they
    are counted; a small batch bounds what is found in it, otherwise that is written under ``stage``."""
    key = ["stream", "msg_id"]
    ids = batch.where(F.col("stream").isNotNull() & F.col("msg_id").isNotNull()).select(*key, order)

    def sized(rows: DataFrame, name: str) -> tuple[DataFrame, int | None]:
        if n_ids is None or n_ids <= BROADCAST_ROWS or stage is None:
            return rows, n_ids
        kept = saved(rows, name, stage)
        return kept, kept.count()

    repeated = sized(ids.groupBy(*key).agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_copies"))
                     .where(F.col("_copies") > 1).drop("_copies"), "repeated")
    found = [ids.join(hinted(*repeated), key).where(F.col(order) > F.col("_first"))]
    if known is not None:
        # A small batch is broadcast to the known ids, so they are scanned but not shuffled.
        seen = sized(known.select(*key).join(hinted(ids.select(*key), n_ids), key, "left_semi").distinct(), "seen")
        found.append(ids.join(hinted(*seen), key, "left_semi"))
    return [rows.select(order) for rows in found]


def drop_duplicates(captured: DataFrame, order: str, known: DataFrame | None = None,
                    n_rows: int | None = None) -> DataFrame:
    """The messages that would be stored."""
    return mark_status(captured, order, known, n_rows).where(F.col("status") == OK).drop("status")


def assign_seq(messages: DataFrame, order: str, start_after: int = 0) -> DataFrame:
    """Dense stream sequences following ``start_after``, in the order of a unique integer column."""
    return dense_seq(messages, [], order, "stream_seq") \
        .withColumn("stream_seq", F.col("stream_seq") + F.lit(start_after))


@dataclass(frozen=True)
class PublishResult:
    """Outcome of one publish: the number of messages per status, and a row per message with
    ``status`` and, where stored, ``stream_seq``. The rows come from the staged files; call
    ``discard`` once they are no longer needed."""

    messages: DataFrame
    counts: dict[str, int]
    stage: str

    def discard(self) -> None:
        discard(self.messages.sparkSession, self.stage)


def publish(messages: DataFrame, path: str, registry: DataFrame, *, strict: bool = True,
            order_by: Sequence[str | Column] = (), dedupe: bool = True, dedupe_since: Column | None = None,
            partition_tokens: tuple[int, ...] = (), writers: int | None = None,
            max_records_per_file: int | None = None, batch_id: str | None = None) -> PublishResult:
    """Append messages to a stored log with dense sequences per stream.

    The batch is staged once in the shared folder, which fixes row addresses: sequences,
    duplicates and results all derive from the staged files and come out the same however
    often a task is retried. ``order_by`` (a unique order) sorts the batch first; without it
    messages keep the order of their partitions. ``dedupe_since`` limits the look-up of known
    ids to stored messages at or past that time. One writer per stream at a time. With ``writers``, so many tasks
    append; of a batch of over 2²⁰ rows for each they append one part after the other, in the order of the batch.

    ``batch_id`` makes a replay harmless, with message ids or without: the batch is staged in a folder of
    its own beside the log, its number is stored with its rows, and a marker is left when all of it is
    appended. A replay that finds the marker stores nothing. One that finds none looks for the rows that
    carry the number: if there are none it starts anew, if some are missing it appends those, from the
    staged files, whatever was published in between.
    """
    spark = messages.sparkSession
    home = os.path.join(path, BATCHES, batch_id) if batch_id else None
    options = (partition_tokens, writers, max_records_per_file)
    if home:
        replayed = _replay(spark, path, home, batch_id, options)
        if replayed is not None:
            return replayed
    filters = FilterSet.of(spark, live(registry).select("filter", "stream"))
    if order_by and filters.size <= BROADCAST_ROWS:
        # Capture by broadcast leaves rows where they are and is better done once they are
        # spread. The sort comes last: below a join it would be dropped as pointless.
        captured = _capture(messages.repartitionByRange(*order_by), filters).sortWithinPartitions(*order_by)
    elif order_by:
        captured = _capture(messages, filters).repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    else:
        captured = _capture(messages, filters)
    stage = os.path.join(home, "stage") if home else shared_dir(spark, "publish")
    batch = saved(captured.withColumn("_addr", F.monotonically_increasing_id()), "batch", stage)
    # One row per stream and span of addresses.
    runs = batch.groupBy("stream", F.shiftright("_addr", SPAN_BITS)).agg(
        F.count(F.lit(1)).alias("n"), F.count("msg_id").alias("with_id"))
    stored_here = F.col("stream").isNotNull()
    total = lambda column, rows: F.coalesce(F.sum(F.when(rows, F.col(column))), F.lit(0))
    size = runs.agg(
        total("n", F.lit(True)).alias("rows"), total("n", ~stored_here).alias("failed"),
        total("with_id", stored_here).alias("ids"), F.count(F.lit(1)).alias("runs")).first()
    if strict and size.failed:
        subjects = [row.subject for row in rejected(batch).select("subject").limit(5).collect()]
        discard(spark, home or stage)
        raise CaptureError(f"{size.failed} messages have a subject no stream captures, such as {subjects}")

    exists = log_exists(spark, path)
    copies = None
    if dedupe and size.ids:
        ids = batch.where(stored_here & F.col("msg_id").isNotNull()).select("stream", "msg_id")
        known = known_ids(spark, path, ids, size.ids, dedupe_since, partition_tokens) if exists else None
        # Written out: the log changes below, and these rows must not follow it.
        copies = saved(union_all(_duplicates(batch, "_addr", known, size.ids, stage)).distinct(), "copies", stage)
    n_copies = copies.count() if copies is not None else 0
    counts = {OK: size.rows - size.failed - n_copies, DUPLICATE: n_copies, FAILED: size.failed}

    kept = batch.where(stored_here).select("stream", "_addr")
    if n_copies:
        kept = kept.join(hinted(copies, n_copies), "_addr", "left_anti")
    before = stream_heads(spark, path) if exists else spark.createDataFrame([], "stream STRING, head LONG")
    # Sequences come from the spans of addresses that are kept; payloads stay where they are. The spans are
    # written out: the heads move with the append.
    spans = saved(marked_spans(kept, ["stream"], "_addr").join(before, "stream", "left").fillna(0, ["head"]), "spans", stage)
    if home:
        mark(spark, home, _STAGED)
    stored = _numbered(batch, spans, size.runs).where(F.col("stream_seq").isNotNull())
    if counts[OK]:
        _append(stored, path, batch_id, options, counts[OK])
        _finish(spark, path, home, size.ids)
    elif home:
        mark(spark, home, _DONE)
    return PublishResult(_outcome(batch, spans, size.runs), counts, stage)


# Markers of a batch: its rows are staged; its rows are all in the log.
_STAGED, _DONE = "_staged", "_done"


def _numbered(batch: DataFrame, spans: DataFrame, n_spans: int, how: str = "inner") -> DataFrame:
    """Staged rows with the ``stream_seq`` they get, NULL for those that are left out."""
    marked_, before_ = in_span("_addr")
    spans = spans if n_spans > MAX_SPANS else F.broadcast(spans)
    return (batch.withColumn("_span", F.shiftright("_addr", SPAN_BITS)).join(spans, ["stream", "_span"], how)
            .withColumn("stream_seq", F.when(marked_, F.col("head") + F.col("_offset") + before_ + 1).cast("long"))
            .select(*batch.columns, "stream_seq"))


def _outcome(batch: DataFrame, spans: DataFrame, n_spans: int) -> DataFrame:
    status = F.when(F.col("stream").isNull(), FAILED).when(F.col("stream_seq").isNull(), DUPLICATE).otherwise(OK)
    return _numbered(batch, spans, n_spans, "left").withColumn("status", status).drop("_addr")


def _append(stored: DataFrame, path: str, batch_id: str | None, options: tuple, n_rows: int) -> None:
    """Append numbered rows; those of a batch with a number carry it, and their place in the staged files. Where the
    number of writers is given, they take one part of the batch after the other, so that what a writer sorts is bounded."""
    partition_tokens, writers, max_records_per_file = options
    parts = [stored]
    if writers and n_rows > writers * WRITER_ROWS:
        parts = [stored.where(part) for part in _parts(stored, writers * WRITER_ROWS)]
    for rows in parts:
        if batch_id:
            rows = rows.withColumns({BATCH: F.lit(batch_id), BATCH_ROW: F.col("_addr")})
        append_log(rows, path, partition_tokens, writers, max_records_per_file)


def _parts(stored: DataFrame, n_rows: int) -> list[Column]:
    """Ranges of addresses, in order, with at most so many rows each: small staged files go together, large ones
    are cut. A range is looked up in the row groups, so the staged files are read once in all."""
    files = stored.groupBy(F.shiftright("_addr", ROW_BITS)).agg(
        F.count(F.lit(1)).alias("n"), F.min("_addr").alias("low"), F.max("_addr").alias("high")).orderBy("low").collect()
    starts, room = [], 0
    for file in files:
        if file.n > room:
            starts += range(file.low, file.high + 1, n_rows)
            room = max(n_rows, file.n)
        room -= file.n
    ranges = zip(starts, [*starts[1:], None])
    return [F.col("_addr") >= low if high is None else (F.col("_addr") >= low) & (F.col("_addr") < high) for low, high in ranges]


def _finish(spark: SparkSession, path: str, home: str | None, n_ids: int | None) -> None:
    """What follows an append: heads, side tables, the marker. All of it can be done again."""
    if home:
        mark(spark, home, _DONE)
    record_heads(stream_heads(spark, path), path)
    side.extend(spark, path, n_ids)


def _replay(spark: SparkSession, path: str, home: str, batch_id: str, options: tuple) -> PublishResult | None:
    """The result of a batch that was begun before, or None if it is to be stored as if it were new."""
    stage = os.path.join(home, "stage")
    if not marked(spark, home, _DONE):
        if not marked(spark, home, _STAGED):
            discard(spark, home)  # died while staging: nothing is in the log
            return None
        batch, spans = (spark.read.parquet(os.path.join(stage, name)) for name in ("batch", "spans"))
        log = open_log(spark, path, options[0], batches=True) if log_exists(spark, path) else None
        if log is None:
            discard(spark, home)
            return None
        heads = spans.select("stream", "head").distinct()
        since = past_heads(log, heads).select("stream", "stream_seq", BATCH, BATCH_ROW)
        own = saved(since.where(F.col(BATCH) == batch_id).select(F.col(BATCH_ROW).alias("_addr")).distinct(), "own")
        there = own.count()
        if not there:
            discard(spark, home)
            return None
        n_spans = spans.count()
        missing = _numbered(batch, spans, n_spans).where(F.col("stream_seq").isNotNull()) \
            .join(hinted(own, there), "_addr", "left_anti")
        # Where something else was stored since, what is missing follows the present head; elsewhere it keeps its place.
        others = since.where(F.col(BATCH).isNull() | (F.col(BATCH) != batch_id)).select("stream").distinct()
        moved = others.join(stream_heads(spark, path), "stream").select("stream", F.col("head").alias("_now"))
        again = marked_spans(missing.join(moved, "stream", "left_semi").select("stream", "_addr"), ["stream"], "_addr") \
            .join(moved, "stream").withColumnRenamed("_now", "head")
        again = saved(again, f"again-{uuid.uuid4().hex}", stage)
        n_again = again.count()
        late = _numbered(missing.drop("stream_seq"), again, n_again)
        kept = missing.join(moved, "stream", "left_anti")
        rest = saved(kept.unionByName(late), f"rest-{uuid.uuid4().hex}", stage)
        n_rest = rest.count()
        if n_rest:
            _append(rest, path, batch_id, options, n_rest)
        _finish(spark, path, home, None)
        return PublishResult(rest.drop("_addr").withColumn("status", F.lit(OK)), {OK: n_rest, DUPLICATE: 0, FAILED: 0}, stage)
    none = spark.createDataFrame([], ENVELOPE).withColumn("status", F.lit(OK))
    return PublishResult(none, {OK: 0, DUPLICATE: 0, FAILED: 0}, stage)


def forget_batch(spark: SparkSession, path: str, batch_id: str) -> None:
    """Drop what is kept of a batch that will not be replayed any more."""
    discard(spark, os.path.join(path, BATCHES, batch_id))


def publish_sql(spark: SparkSession, query: str, path: str, registry: DataFrame, *,
                subject: str | None = None, format: P.Codec = "json", columns: Sequence[str] | None = None,
                **options) -> PublishResult:
    """``INSERT INTO … SELECT``: publish the rows of a SQL query; columns named ``subject`` and
    ``headers`` are metadata, all others make up the payload."""
    rows = spark.sql(query)
    return publish(outgoing(rows, subject=subject, format=format, columns=columns), path, registry, **options)
