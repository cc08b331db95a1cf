"""``read_log``: one entry point from read options to a DataFrame.

The order of the steps is what makes a read cheap: stream and subject predicates
and start positions come first and reach the scan, then stop positions and limits
cut the log, and only what is left is decoded.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msglog.functions import metadata as M
from msglog.functions import payload as P
from msglog.functions.subjects import TokenColumns
from msglog.operators import positions
from msglog.operators.discovery import in_force
from msglog.operators.progress import unacknowledged, with_attempt
from msglog.operators.sequence import SPAN_BITS, first_n
from msglog.operators.sequence import positions as number
from msglog.operators.splits import FilterSet, check_no_overlap, hinted, match_splits
from msglog.sources.side import COUNT_BITS, first_sequences
from msglog.sources.store import log_exists, open_log, open_stream, saved, stream_heads, token_columns

# The columns of a registry that matter to a read: a filter may hold for one stream, and for a time.
REGISTRY = frozenset(("stream", "filter", "from_seq", "to_seq"))


@dataclass(frozen=True)
class ReadOptions:
    """Options of a read; see README for the meaning of each."""

    stream: str | None = None
    filters: Sequence[str] | DataFrame | None = None
    registry: DataFrame | None = None
    consumer_prefix: str = "consumer"
    start: tuple = ("earliest",)
    stop: tuple = ("latest",)
    snapshot: int | None = None
    limit: int | None = None
    format: P.Codec = "string"
    schema: T.StructType | str | None = None
    on_error: str = "fail"
    metadata: Sequence[str] = ()
    names: Mapping[str, str] = field(default_factory=dict)
    watermark: str | None = None
    headers_only: bool = False
    deliveries: DataFrame | None = None
    acks: DataFrame | None = None
    partition_tokens: tuple[int, ...] = ()
    tokens: TokenColumns | None = None
    seq: positions.SeqColumn | None = None
    max_files: int | None = None
    max_bytes: int | None = None

    ack: str = "none"

    def check(self) -> ReadOptions:
        positions.check_rule("start", self.start)
        if not callable(self.stop):
            positions.check_rule("stop", self.stop)
        if self.ack not in ("none", "all", "each"):
            raise ValueError("ack must be 'none', 'all' or 'each'")
        if (self.ack == "none") != (self.acks is None):
            raise ValueError("the acks so far and an ack policy, 'all' or 'each', go together")
        if self.filters is not None and self.registry is not None:
            raise ValueError("give explicit filters or a registry of default filters, not both")
        if self.on_error not in ("fail", "null"):
            raise ValueError("on_error must be 'fail' or 'null'")
        if self.stream is not None and not re.fullmatch(r"[^\s.*>\\/]+", self.stream):
            raise ValueError(f"invalid stream name {self.stream!r}")
        if self.limit is not None and self.limit < 1:
            raise ValueError("a message limit must be at least 1")
        M.check_metadata(self.metadata)
        if self.needs_split and self.filters is None and self.registry is None:
            raise ValueError("consumer, consumerSeq, pending and past deliveries need filters or a registry")
        if self.format != "string" and not callable(self.format) and not self.headers_only and self.schema is None:
            raise ValueError(f"format {self.format!r} needs a declared schema")
        return self

    @property
    def needs_split(self) -> bool:
        return self.deliveries is not None or self.acks is not None or any(k in ("consumer", "consumerSeq", "pending") for k in self.metadata)

    @property
    def bounded(self) -> bool:
        return positions.is_bounded(self.stop)


def read_log(spark: SparkSession, path: str | None = None, *, frame: DataFrame | None = None,
             **options) -> DataFrame:
    """Read a stored log (``path``) or any frame in the envelope schema (``frame``).

    With stop rule ``never`` the result is a streaming DataFrame, otherwise a batch one.
    """
    opts = ReadOptions(**options).check()
    tokens = opts.tokens or token_columns(opts.partition_tokens)
    if frame is not None:
        log = frame
    elif path is None:
        raise ValueError("a log path or a frame is needed")
    elif opts.bounded:
        log = open_log(spark, path, opts.partition_tokens)
    else:
        log = open_stream(spark, path, opts.partition_tokens, opts.max_files, opts.max_bytes)
    if log.isStreaming == opts.bounded:
        raise ValueError(f"stop rule {opts.stop[0]!r} does not fit a {'streaming' if log.isStreaming else 'batch'} log")
    if opts.stream is not None:
        log = log.where(F.col("stream") == opts.stream)
    if path is not None and log.isStreaming and opts.start[0] == "latest" and opts.snapshot is None:
        log = _past_heads(spark, log, path, opts.stream)
        opts = replace(opts, start=("earliest",))
    counts = None
    if path is not None and opts.bounded and (opts.limit is not None or (not callable(opts.stop) and opts.stop[0] == "count")):
        counts = StoredCounts.of(spark, path, opts)
    heads = stream_heads(spark, path) if path is not None and not log.isStreaming and log_exists(spark, path) else None
    return decode_log(select_messages(spark, log, opts, tokens, counts, heads), opts)


def _past_heads(spark: SparkSession, log: DataFrame, path: str, stream: str | None) -> DataFrame:
    """What is appended to a stored log from now on: past the present head of each stream."""
    heads = saved(stream_heads(spark, path), "heads") if log_exists(spark, path) else None
    if heads is None:
        return log
    if stream is not None:
        head = heads.where(F.col("stream") == stream).first()
        return log if head is None else log.where(positions.seq_from(log, head["head"] + 1))
    return (log.join(hinted(heads, heads.count()), "stream", "left")
            .where(F.col("head").isNull() | (F.col("stream_seq") > F.col("head"))).select(*log.columns))


@dataclass(frozen=True)
class StoredCounts:
    """What the side tables of a stored log tell about where its first messages are."""

    spark: SparkSession
    path: str
    stream: str | None
    first: int
    last: int

    @classmethod
    def of(cls, spark: SparkSession, path: str, opts: ReadOptions) -> StoredCounts | None:
        if not log_exists(spark, path):
            return None
        last = stream_heads(spark, path).agg(F.max("head")).first()[0]
        first = opts.start[1] if opts.start[0] == "seq" else 0
        return None if last is None else cls(spark, path, opts.stream, first, last)

    def cut(self, log: DataFrame, n: int, token: str | None, exact: bool) -> DataFrame:
        """``log`` cut to a part from its begin that holds ``n`` of its rows, if it has as many. The counts name
        the first guess: by stream and first subject token, they are never too low, and without filters
        they are right. A guess that held too little is doubled."""
        end = first_sequences(self.spark, self.path, n, self.stream, self.first, token)
        if end is None:  # the counts end before, or there are none
            end, exact = self.first + min(1 << COUNT_BITS, positions.BLOCK), False
        while end <= self.last:
            part = log.where((F.col(positions.BLOCK_COLUMN) < -(-end // positions.BLOCK)) & (F.col("stream_seq") < end))
            if exact or part.limit(n).count() == n:
                return part
            exact, end = False, self.first + 2 * (end - self.first)
        return log


def _first_token(filters: FilterSet | None) -> str | None:
    """The first subject token that all filters of a short list share."""
    tokens = {f.split(".")[0] for f in filters.inline} if filters is not None else set()
    return tokens.pop() if len(tokens) == 1 and not tokens & {"*", ">"} else None


def select_messages(spark: SparkSession, log: DataFrame, opts: ReadOptions,
                    tokens: TokenColumns | None = None, counts: StoredCounts | None = None,
                    heads: DataFrame | None = None) -> DataFrame:
    """The envelopes a read delivers, before any payload is decoded. ``counts`` and ``heads``: of a stored
    log, for reads that take the first messages, and for those that number messages."""
    streaming = log.isStreaming
    if streaming and (opts.limit is not None or "consumerSeq" in opts.metadata or "pending" in opts.metadata):
        raise ValueError("limit, consumerSeq and pending need a bounded read")
    if streaming and opts.start[0] == "latest" and opts.snapshot is None:
        raise ValueError("start rule 'latest' on a streaming frame needs a snapshot sequence; a log path does not")
    log = positions.start_at(log, opts.start, opts.snapshot, opts.seq)

    split, n_splits, one_stream = None, None, opts.stream is not None
    filters = opts.registry.select(*REGISTRY.intersection(opts.registry.columns)) if opts.registry is not None else opts.filters
    if filters is not None:
        if opts.registry is None:
            check_no_overlap(spark, filters)
        chosen = FilterSet.of(spark, filters)
        log = match_splits(log, chosen, opts.consumer_prefix, tokens=tokens, disjoint=opts.registry is None)
        split, n_splits = "split_id", chosen.size
        if opts.registry is not None:
            # A history may hold a filter several times or for other streams: no number of splits.
            log, n_splits = in_force(log), None
    plain, token = split is None and opts.start[0] == "earliest", _first_token(chosen if split else None)
    if counts is not None and not callable(opts.stop) and opts.stop[0] == "count":
        log = counts.cut(log, opts.stop[1], token, plain)
    log = positions.stop_at(log, opts.stop, split, n_splits, opts.snapshot, opts.seq, one_stream)
    if opts.ack != "none":
        log = unacknowledged(log, opts.acks, opts.ack)
    if "consumerSeq" in opts.metadata or "pending" in opts.metadata:
        # A look at the last sequence bounds what is sent; the rows themselves stay where they are.
        ends = heads if heads is not None else log.groupBy("stream").agg(F.max("stream_seq").alias("head"))
        if opts.stream is not None:
            ends = ends.where(F.col("stream") == opts.stream)
        spans = ends.agg(F.sum(F.shiftright("head", SPAN_BITS) + 1)).first()[0] or 0
        log = number(log, ["split_id"], "stream_seq", "consumer_seq", pending="pending", n_spans=spans * chosen.size)
    if "delivered" in opts.metadata and "delivered" not in log.columns:
        log = with_attempt(log, opts.deliveries)
    if opts.limit is not None:
        if counts is not None:
            log = counts.cut(log, opts.limit, token, False)
        ties = () if one_stream and split is None else positions.tie_columns(log, split)
        log = first_n(log, opts.limit, physical=opts.seq, ties=ties)
    if opts.watermark is not None:
        log = log.withColumn("event_time", M.event_time(F.col("timestamp"))).withWatermark("event_time", opts.watermark)
    return log


def decode_log(log: DataFrame, opts: ReadOptions) -> DataFrame:
    """Payload columns, then metadata columns."""
    physical: list[Column | str] = ["event_time"] if opts.watermark is not None else []
    if opts.headers_only:
        physical.append(F.octet_length("data").alias("n_bytes"))
        return M.project(log, physical, opts.metadata, opts.names)
    mode = "FAILFAST" if opts.on_error == "fail" else "PERMISSIVE"
    value = P.parsed(F.col("data"), opts.format, opts.schema, mode)
    if opts.on_error == "fail" and opts.format in ("json", "csv", "avro"):
        # A generator lets predicates on subject and metadata pass below it but keeps those on
        # payload fields above: a message the subject predicate excludes is never parsed.
        value = F.explode(F.array(value))
    decoded = log.withColumn("payload", value)
    is_row = isinstance(decoded.schema["payload"].dataType, T.StructType)
    physical.append("payload.*" if is_row else F.col("payload").alias("value"))
    return M.project(decoded, physical, opts.metadata, opts.names)


def create_log_view(spark: SparkSession, name: str, path: str | None = None, **options) -> DataFrame:
    """Register a read under a name for use in ``spark.sql``."""
    frame = read_log(spark, path, **options)
    frame.createOrReplaceTempView(name)
    return frame
