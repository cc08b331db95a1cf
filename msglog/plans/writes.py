"""Queries on publishing, watermarks in streams, progress and statistics."""

from __future__ import annotations

from datetime import date

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msglog.functions import headers as H
from msglog.functions import payload as P
from msglog.operators import progress as G
from msglog.operators import publish as W
from msglog.operators import stats
from msglog.operators.discovery import discover_filters, unread
from msglog.operators.positions import last_seq
from msglog.operators.splits import values, with_split
from msglog.plans.catalog import query
from msglog.plans.inputs import (acks, compressing, deliveries, instant, k_of, log, n_splits, progress, type_filters,
                                 split_log, splits)
from msglog.sources.adapters import EVENT_SEQ, EVENT_TOKENS, documents_log, events_log, events_stream, orders_log, table
from msglog.sources import side
from msglog.sources.log import read_log
from msglog.sources.store import append_log, discard, open_log, open_stream, shared_dir
from msglog.streaming import flows
from msglog.streaming.redelivery import redeliver_stream


def _registry(spark: SparkSession, *entries: tuple[str, str]) -> DataFrame:
    return values(spark, [{"stream": s, "filter": f} for s, f in entries])


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders")


# --- encoding, routing, headers ------------------------------------------------------

@query("encode_json", """SELECT o_orderkey, o_orderstatus, o_totalprice, true AS keeps_null FROM O""", ("O",))
def encode_json(spark: SparkSession, sf: str) -> DataFrame:
    """Physical columns as JSON, read back field by field; a null field stays in the document."""
    rows = _orders(spark, sf).select("o_orderkey", "o_orderstatus", "o_totalprice",
                                     F.lit(None).cast("string").alias("note"), F.lit("orders.all").alias("subject"))
    document = P.text(F.col("data"))
    field = lambda name: F.get_json_object(document, f"$.{name}")
    return W.outgoing(rows).select(
        field("o_orderkey").cast("long").alias("o_orderkey"), field("o_orderstatus").alias("o_orderstatus"),
        field("o_totalprice").cast("double").alias("o_totalprice"),
        document.contains('"note":null').alias("keeps_null"))


@query("encode_udf", "SELECT subject, text AS value FROM D", ("D",))
def encode_udf(spark: SparkSession, sf: str) -> DataFrame:
    """A custom encoder, checked by decoding what it wrote."""
    rows = documents_log(spark, sf).select("subject", P.text(F.col("data")).alias("text"))
    deflate, inflate = compressing()
    sent = W.outgoing(rows, format=deflate, columns=F.col("text"))
    return sent.select("subject", inflate("data").alias("value"))


@query("route_static", "SELECT 'orders.all' AS subject, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS sum_key FROM O", ("O",))
def route_static(spark: SparkSession, sf: str) -> DataFrame:
    rows = _orders(spark, sf).withColumn("subject", F.concat(F.lit("ignored."), "o_orderstatus"))
    return _by_subject(W.outgoing(rows, subject="orders.all"))


@query("route_dynamic", """SELECT 'out.' || o_orderstatus AS subject, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS sum_key
  FROM O GROUP BY 1""", ("O",))
def route_dynamic(spark: SparkSession, sf: str) -> DataFrame:
    return _by_subject(W.outgoing(_orders(spark, sf).withColumn("subject", F.concat(F.lit("out."), "o_orderstatus"))))


@query("route_hash", """SELECT 'orders.' || (o_custkey % 10) AS subject, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS sum_key
  FROM O GROUP BY 1""", ("O",))
def route_hash(spark: SparkSession, sf: str) -> DataFrame:
    return _by_subject(W.outgoing(_orders(spark, sf), by=W.hash_subject("orders", F.col("o_custkey"), 10)))


def _by_subject(messages: DataFrame) -> DataFrame:
    key = F.get_json_object(P.text(F.col("data")), "$.o_orderkey").cast("long")
    return messages.groupBy("subject").agg(F.count(F.lit(1)).alias("n"), F.sum(key).alias("sum_key"))


@query("headers_write", """SELECT stream_seq, 2 AS n_keys, event_type || '|' || CAST(k AS VARCHAR) AS labels, CAST(user_id AS VARCHAR) AS sender FROM L""")
def headers_write(spark: SparkSession, sf: str) -> DataFrame:
    rows = log(spark, sf).select("subject", "stream_seq", F.create_map(
        F.lit("labels"), F.array(F.col("event_type"), k_of().cast("string")),
        F.lit("empty"), F.array().cast("array<string>"),
        F.lit("sender"), F.array(F.col("user_id").cast("string"))).alias("headers"))
    h = F.col("headers")
    return W.outgoing(rows, keep=["stream_seq"]).select(
        "stream_seq", F.size(h).alias("n_keys"), F.array_join(h["labels"], "|").alias("labels"),
        H.first_value(h, "sender").alias("sender"))


@query("headers_event_time", """SELECT stream_seq, epoch_us("timestamp") // 1000 AS event_ms FROM L""")
def headers_event_time(spark: SparkSession, sf: str) -> DataFrame:
    sent = W.outgoing(log(spark, sf).drop("headers"), format="string", columns=P.text(F.col("data")),
                      event_time=F.col("timestamp"), keep=["stream_seq"])
    return sent.select("stream_seq", H.first_value(F.col("headers"), H.EVENT_TIME_HEADER).cast("long").alias("event_ms"))


# --- capture, duplicates, sequences ------------------------------------------------------

@query("capture_reject", "SELECT subject, count(*) AS n FROM L WHERE event_type IN ('signup', 'view') GROUP BY subject")
def capture_reject(spark: SparkSession, sf: str) -> DataFrame:
    streams = _registry(spark, ("clicks", "events.click.>"), ("errors", "events.error.*"), ("sales", "events.purchase.*"))
    captured = W.capture(log(spark, sf).drop("stream"), streams)
    return W.rejected(captured).groupBy("subject").agg(F.count(F.lit(1)).alias("n"))


def _repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Every message, then every click and purchase a second time; ``pub`` is the order."""
    source = log(spark, sf)
    copies = F.when(F.col("event_type").isin("click", "purchase"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    span = source.agg(F.max("stream_seq").alias("m")).scalar()
    return (source.withColumn("_copy", F.explode(copies))
            .withColumn("pub", F.col("stream_seq") + F.col("_copy") * span).drop("_copy"))


_REPEATED = """, R AS (SELECT *, stream_seq AS pub FROM L UNION ALL
  SELECT *, stream_seq + (SELECT max(stream_seq) FROM L) FROM L WHERE event_type IN ('click', 'purchase'))"""


@query("dedupe_batch", _REPEATED + """, U AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY pub) AS rn FROM R)
  SELECT CAST(event_id AS VARCHAR) AS msg_id, subject, pub FROM U WHERE rn = 1 AND "timestamp" >= TIMESTAMP '2024-01-05' """)
def dedupe_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Copies within the batch go, and so does what the log holds: all before 2024-01-05."""
    stored = log(spark, sf).where(F.col("timestamp") < instant("2024-01-05 00:00:00"))
    return W.drop_duplicates(_repeated(spark, sf), "pub", known=stored).select("msg_id", "subject", "pub")


@query("dedupe_window", "SELECT DISTINCT CAST(event_id AS VARCHAR) AS msg_id, subject FROM L")
def dedupe_window(spark: SparkSession, sf: str) -> DataFrame:
    """Each message arrives twice in one stream; state remembers ids for an hour of event time."""
    twice = events_stream(spark, sf).withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    unique = flows.dedupe_stream(twice, "1 hour").select("msg_id", "subject")
    out = shared_dir(spark, "dedupe")
    flows.drain(unique, f"{out}/rows", f"{out}/checkpoint")
    return spark.read.schema(unique.schema).parquet(f"{out}/rows")


def _results(spark: SparkSession, sf: str) -> DataFrame:
    """Publish outcomes of the repeated log where ``signup`` subjects are not captured."""
    streams = _registry(spark, *[("events", f) for f in type_filters(spark, sf) if "signup" not in f])
    messages = _repeated(spark, sf).drop("stream", "stream_seq")
    return W.publish(messages, shared_dir(spark, "log"), streams, strict=False, order_by=["pub"]).messages


_STATUS = _REPEATED + """, P AS (SELECT *, CASE WHEN event_type = 'signup' THEN 'failed'
  WHEN row_number() OVER (PARTITION BY event_id ORDER BY pub) > 1 THEN 'duplicate' ELSE 'ok' END AS status FROM R)"""


@query("publish_result", _STATUS + " SELECT pub, subject, status FROM P")
def publish_result(spark: SparkSession, sf: str) -> DataFrame:
    return _results(spark, sf).select("pub", "subject", "status")


@query("flow_out", _STATUS + """ SELECT status, count(*) AS n_records, CAST(sum(octet_length(encode(props))) AS BIGINT) AS n_bytes
  FROM P GROUP BY status""")
def flow_out(spark: SparkSession, sf: str) -> DataFrame:
    return stats.flow_out(_results(spark, sf))


@query("assign_seq", """SELECT conv_id, turn, 100 + row_number() OVER (ORDER BY conv_id, turn, role) AS stream_seq
  FROM conversations""", ())
def assign_seq(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns become one dense sequence that follows sequence 100."""
    path = shared_dir(spark, "turns")
    # Written in order: the address of a row is its place, whatever the ids and turns are.
    (table(spark, sf, "conversations").repartitionByRange("conv_id", "turn", "role").sortWithinPartitions("conv_id", "turn", "role")
     .withColumn("_order", F.monotonically_increasing_id()).write.parquet(path))
    return W.assign_seq(spark.read.parquet(path), "_order", start_after=100).select("conv_id", "turn", "stream_seq")


# --- sinks ------------------------------------------------------------------------------------

def _order_messages(spark: SparkSession, sf: str) -> DataFrame:
    source = orders_log(spark, sf)
    return W.outgoing(source, format=lambda data: data, columns=F.col("data"), timestamp=F.col("timestamp"),
                      msg_id=F.col("msg_id"), keep=["stream_seq"]).withColumnRenamed("stream_seq", "o")


@query("sink_batch", """SELECT subject, row_number() OVER (ORDER BY o_orderkey) AS stream_seq, o_orderkey,
  o_totalprice FROM O""", ("O",))
def sink_batch(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "log")
    W.publish(_order_messages(spark, sf), path, _registry(spark, ("orders", "orders.>")), order_by=["o"]).discard()
    document = P.text(F.col("data"))
    return open_log(spark, path).where(F.col("stream") == "orders").select(
        "subject", "stream_seq", F.get_json_object(document, "$.o_orderkey").cast("long").alias("o_orderkey"),
        F.get_json_object(document, "$.o_totalprice").cast("double").alias("o_totalprice"))


@query("sink_stream", """SELECT subject, count(*) AS n, CAST(sum(k) AS BIGINT) AS sum_k,
  (SELECT max(stream_seq) FROM L) AS stream_last FROM L GROUP BY subject""")
def sink_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table streamed into a log; sequences stay dense across micro-batches."""
    path = shared_dir(spark, "log")

    def prepare(batch: DataFrame) -> DataFrame:
        return W.outgoing(batch, format=lambda data: data, columns=F.col("data"),
                          timestamp=F.col("timestamp"), msg_id=F.col("msg_id"))

    flows.publish_stream(events_stream(spark, sf, max_files=1), path,
                         lambda s: _registry(s, ("events", "events.>")), f"{path}-checkpoint", prepare).awaitTermination()
    stored = open_log(spark, path)
    per_subject = stored.groupBy("subject").agg(F.count(F.lit(1)).alias("n"), F.sum(k_of()).alias("sum_k"))
    return per_subject.withColumn("stream_last", stored.agg(F.max("stream_seq")).scalar())


@query("sink_stream_replay", """SELECT subject, count(*) AS n, min(stream_seq) AS first_seq, max(stream_seq) AS last_seq FROM (
    SELECT subject, row_number() OVER (ORDER BY o_orderkey) AS stream_seq FROM O) GROUP BY subject""", ("O",))
def sink_stream_replay(spark: SparkSession, sf: str) -> DataFrame:
    """A batch without message ids is replayed; its number keeps it from being stored twice."""
    path, streams = shared_dir(spark, "log"), _registry(spark, ("orders", "orders.>"))
    messages = _order_messages(spark, sf).withColumn("msg_id", F.lit(None).cast("string"))
    for _ in range(2):
        W.publish(messages, path, streams, order_by=["o"], batch_id="batch-0").discard()
    return open_log(spark, path).groupBy("subject").agg(
        F.count(F.lit(1)).alias("n"), F.min("stream_seq").alias("first_seq"), F.max("stream_seq").alias("last_seq"))


@query("sink_replay_after_failure", """SELECT CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'rest' END AS stream,
  count(*) * CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS n, 1 AS first_seq,
  count(*) * CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS last_seq FROM
  (SELECT CASE WHEN o_orderstatus = 'O' THEN 'O' ELSE '-' END AS o_orderstatus FROM O) GROUP BY o_orderstatus""", ("O",))
def sink_replay_after_failure(spark: SparkSession, sf: str) -> DataFrame:
    """The append of a batch without ids dies when one of its two streams is visible; another publish goes to
    that stream before the batch is replayed. Each message is stored once."""
    path = shared_dir(spark, "log")
    streams = _registry(spark, ("open", "orders.O.>"), ("rest", "orders.F.>"), ("rest", "orders.P.>"))
    messages = _order_messages(spark, sf).withColumn("msg_id", F.lit(None).cast("string"))
    W.publish(messages, path, streams, order_by=["o"], batch_id="batch-0")
    for part in ("stream=rest", "_heads", "_side", "_batches/batch-0/_done"):
        discard(spark, f"{path}/{part}")
    W.publish(messages.where("subject LIKE 'orders.O.%'"), path, streams, order_by=["o"]).discard()
    W.publish(messages, path, streams, order_by=["o"], batch_id="batch-0").discard()
    return open_log(spark, path).groupBy("stream").agg(
        F.count(F.lit(1)).alias("n"), F.min("stream_seq").cast("int").alias("first_seq"), F.max("stream_seq").alias("last_seq"))


@query("sink_dedupe_stored", """, R AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY part, o_orderkey) AS rn FROM
    (SELECT *, 1 AS part FROM O WHERE o_orderkey % 3 < 2 UNION ALL SELECT *, 2 FROM O WHERE o_orderkey % 3 > 0))
  SELECT part, count(*) AS n, count(*) FILTER (rn = 1) AS stored FROM R GROUP BY part""", ("O",))
def sink_dedupe_stored(spark: SparkSession, sf: str) -> DataFrame:
    """A second batch repeats ids of the first, which are found in the id table of the log."""
    path, streams = shared_dir(spark, "log"), _registry(spark, ("orders", "orders.>"))
    messages, parts = _order_messages(spark, sf).withColumn("key", F.col("msg_id").cast("long")), []
    for part, some in ((1, "key % 3 < 2"), (2, "key % 3 > 0")):
        result = W.publish(messages.where(some), path, streams, order_by=["o"])
        parts.append(result.messages.agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("n"), F.count("stream_seq").alias("stored")))
    return parts[0].unionByName(parts[1])


@query("stored_statistics", """SELECT 'orders' AS stream, count(*) AS n_messages, 1 AS first_seq, count(*) AS last_seq,
  count(DISTINCT subject) AS n_subjects_estimate FROM O""", ("O",))
def stored_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of a stored log from its side tables; so few subjects are estimated exactly."""
    path = shared_dir(spark, "log")
    W.publish(_order_messages(spark, sf), path, _registry(spark, ("orders", "orders.>")), order_by=["o"]).discard()
    return side.stored_info(spark, path).withColumn("first_seq", F.col("first_seq").cast("int"))


@query("stop_count_stored", """SELECT subject, stream_seq FROM (SELECT subject, row_number() OVER (ORDER BY o_orderkey) AS stream_seq FROM O)
  WHERE subject LIKE 'orders.F.%' ORDER BY stream_seq LIMIT 100""", ("O",))
def stop_count_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The first hundred messages of a filter; the counts of the log say where to look."""
    path = shared_dir(spark, "log")
    W.publish(_order_messages(spark, sf), path, _registry(spark, ("orders", "orders.>")), order_by=["o"]).discard()
    return read_log(spark, path, stream="orders", filters=["orders.F.>"], stop=("count", 100), headers_only=True,
                    metadata=["subject", "streamSeq"]).select("subject", F.col("streamSeq").alias("stream_seq"))


@query("consume_catch_up", """SELECT subject, stream_seq FROM L WHERE event_type IN ('click', 'view')""")
def consume_catch_up(spark: SparkSession, sf: str) -> DataFrame:
    """`view` is registered when half of the log has passed; it still delivers from its begin."""
    path, source = shared_dir(spark, "log"), events_log(spark, sf)
    filters = ["events.click.>"]

    def known(session: SparkSession) -> DataFrame:
        return _registry(session, *[("events", f) for f in filters])

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.select("subject", "stream_seq").write.mode("overwrite").parquet(f"{path}-out/batch={epoch}")

    half = last_seq(source) // 2
    for part in (F.col("stream_seq") <= half, F.col("stream_seq") > half):
        append_log(source.where(part), path)
        flows.consume(open_stream(spark, path), keep, f"{path}-checkpoint", known,
                      stored=lambda session: open_log(session, path)).awaitTermination()
        filters.append("events.view.>")
    return spark.read.schema("subject STRING, stream_seq LONG").parquet(f"{path}-out").select("subject", "stream_seq")


class _Stopped(RuntimeError):
    pass


@query("consume_progress", """, T AS (SELECT max(stream_seq) // 3 AS third FROM L)
  SELECT event_type, CASE WHEN event_type = 'view' AND stream_seq > third AND stream_seq <= 2 * third THEN 2
    ELSE least(2, (stream_seq - 1) // third) END AS batch, stream_seq FROM L, T WHERE event_type IN ('click', 'view')""")
def consume_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches; the second one dies in its handler and `view` is paused in it: every message arrives once."""
    path, source, status, dies = shared_dir(spark, "log"), events_log(spark, sf), {"click": "active", "view": "active"}, []

    def known(session: SparkSession) -> DataFrame:
        return values(session, [{"stream": "events", "filter": f"events.{t}.>", "status": x} for t, x in status.items()])

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.select(F.split_part("subject", F.lit("."), F.lit(2)).alias("event_type"), F.lit(epoch).cast("long").alias("batch"), "stream_seq") \
            .write.mode("overwrite").parquet(f"{path}-out/epoch={epoch}")
        if dies:
            raise _Stopped(dies.pop())

    third = last_seq(source) // 3
    for n, part in enumerate((F.col("stream_seq") <= third, F.col("stream_seq").between(third + 1, 2 * third), F.col("stream_seq") > 2 * third)):
        append_log(source.where(part), path)
        status["view"] = "paused" if n == 1 else "active"
        dies += ["as if killed"] * (n == 1)
        for _ in range(2):  # the second run has nothing to do, or the batch that died
            try:
                flows.consume(open_stream(spark, path), keep, f"{path}-checkpoint", known,
                              stored=lambda session: open_log(session, path)).awaitTermination()
            except StreamingQueryException:
                continue
    return spark.read.schema("event_type STRING, batch LONG, stream_seq LONG").parquet(f"{path}-out").select("event_type", "batch", "stream_seq")


@query("flow_out_stream", """SELECT 'ok' AS status, count(*) AS n_records, CAST(sum(octet_length(encode(props))) AS BIGINT) AS n_bytes FROM L""")
def flow_out_stream(spark: SparkSession, sf: str) -> DataFrame:
    """What a publishing query has measured batch by batch."""
    path = shared_dir(spark, "log")

    def prepare(batch: DataFrame) -> DataFrame:
        return W.outgoing(batch, format=lambda data: data, columns=F.col("data"), timestamp=F.col("timestamp"), msg_id=F.col("msg_id"))

    flows.publish_stream(events_stream(spark, sf, max_files=1), path, lambda s: _registry(s, ("events", "events.>")),
                         f"{path}-checkpoint", prepare, metrics=f"{path}-metrics").awaitTermination()
    return flows.flow_metrics(spark, f"{path}-metrics").groupBy("status").agg(
        F.sum("n_records").alias("n_records"), F.sum("n_bytes").alias("n_bytes"))


@query("sink_parallelism", """SELECT subject, count(*) AS n, min(stream_seq) AS first_seq FROM (
    SELECT subject, row_number() OVER (ORDER BY o_orderkey) AS stream_seq FROM O) GROUP BY subject""", ("O",))
def sink_parallelism(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "log")
    W.publish(_order_messages(spark, sf), path, _registry(spark, ("orders", "orders.>")), order_by=["o"],
              writers=4, partition_tokens=(1,), max_records_per_file=5_000_000).discard()
    return open_log(spark, path, (1,)).groupBy("subject").agg(
        F.count(F.lit(1)).alias("n"), F.min("stream_seq").alias("first_seq"))


@query("republish", """, N AS (SELECT count(*) AS n FROM O)
  SELECT subject, count(*) AS n, min(stream_seq) AS first_seq, max(stream_seq) AS last_seq FROM (
    SELECT subject, row_number() OVER (ORDER BY o_orderkey) AS stream_seq FROM O
    UNION ALL SELECT 'orders.again.' || o_orderstatus, n + row_number() OVER (ORDER BY o_orderkey) FROM O, N) GROUP BY subject""",
       ("O",))
def republish(spark: SparkSession, sf: str) -> DataFrame:
    """Read a log up to its present end, rewrite the subjects, publish into the same log."""
    path = shared_dir(spark, "log")
    streams = _registry(spark, ("orders", "orders.>"))
    first = W.publish(_order_messages(spark, sf), path, streams, order_by=["o"])
    stored = open_log(spark, path).where(F.col("stream_seq") <= first.counts[W.OK])
    again = W.outgoing(stored.withColumn("subject", F.regexp_replace("subject", r"^orders\.(\w+)\..*$", "orders.again.$1")),
                       format=lambda data: data, columns=F.col("data"), keep=["stream_seq"])
    W.publish(again.withColumnRenamed("stream_seq", "o"), path, streams, order_by=["o"], dedupe=False).discard()
    return open_log(spark, path).groupBy("subject").agg(
        F.count(F.lit(1)).alias("n"), F.min("stream_seq").alias("first_seq"), F.max("stream_seq").alias("last_seq"))


# --- watermarks in streams ------------------------------------------------------------------------

@query("wm_stream", """SELECT strftime(date_trunc('day', "timestamp"), '%Y-%m-%d') AS day, count(*) AS n FROM L
  GROUP BY date_trunc('day', "timestamp")
  HAVING date_trunc('day', "timestamp") + INTERVAL 1 DAY <= (SELECT date_trunc('milliseconds', max("timestamp")) - INTERVAL 1 HOUR FROM L)""")
def wm_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Daily counts of the closed days only: the watermark holds back the last one."""
    daily = (flows.with_watermark(events_stream(spark, sf), "1 hour")
             .groupBy(F.window("event_time", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n"))
             .select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "n"))
    out = shared_dir(spark, "watermark")
    flows.drain(daily, f"{out}/rows", f"{out}/checkpoint")
    return spark.read.schema(daily.schema).parquet(f"{out}/rows")


@query("wm_split_stream", """, E AS (SELECT event_type, date_trunc('day', "timestamp") AS day, "timestamp" FROM L
    WHERE event_type = 'click' OR (event_type = 'view' AND "timestamp" < TIMESTAMP '2024-01-20')),
  W AS (SELECT min(top) - INTERVAL 1 HOUR AS wm FROM
    (SELECT date_trunc('milliseconds', max("timestamp")) AS top FROM E GROUP BY event_type))
  SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS n FROM E, W GROUP BY day, wm HAVING day + INTERVAL 1 DAY <= wm""")
def wm_split_stream(spark: SparkSession, sf: str) -> DataFrame:
    """`view` ends on the 20th: the slower split holds the watermark of the union back."""
    source = events_stream(spark, sf).where((F.col("event_type") != "view") | (F.col("timestamp") < instant("2024-01-20 00:00:00")))
    merged = flows.split_watermarks(source, ["events.click.>", "events.view.>"], "1 hour", EVENT_TOKENS)
    daily = (merged.groupBy(F.window("event_time", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n"))
             .select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "n"))
    out = shared_dir(spark, "watermark")
    flows.drain(daily, f"{out}/rows", f"{out}/checkpoint")
    return spark.read.schema(daily.schema).parquet(f"{out}/rows")


# --- progress, acknowledgement, redelivery -------------------------------------------------------------

_P = ("L", "S", "deliveries", "acks")


@query("ack_cumulative", """SELECT split_id, stream_seq, attempt FROM deliveries JOIN
  (SELECT split_id, max(stream_seq) AS top FROM acks GROUP BY split_id) USING (split_id) WHERE stream_seq <= top""", _P)
def ack_cumulative(spark: SparkSession, sf: str) -> DataFrame:
    return G.acked_cumulative(deliveries(spark, sf), acks(spark, sf), n_splits(spark, sf)).select("split_id", "stream_seq", "attempt")


@query("ack_pending", """SELECT split_id, stream_seq, attempt FROM deliveries
  WHERE (split_id, stream_seq) NOT IN (SELECT (split_id, stream_seq) FROM acks)""", _P)
def ack_pending(spark: SparkSession, sf: str) -> DataFrame:
    return G.pending(deliveries(spark, sf), acks(spark, sf), "each").select("split_id", "stream_seq", "attempt")


@query("ack_none", "SELECT split_id, stream_seq, attempt FROM deliveries", ("L", "S", "deliveries"))
def ack_none(spark: SparkSession, sf: str) -> DataFrame:
    return G.acked_none(deliveries(spark, sf)).select("split_id", "stream_seq", "attempt")


@query("ack_floor", """, u AS (SELECT split_id, min(stream_seq) AS first_open FROM deliveries
    WHERE (split_id, stream_seq) NOT IN (SELECT (split_id, stream_seq) FROM acks) GROUP BY split_id)
  SELECT split_id, coalesce(max(stream_seq) FILTER (first_open IS NULL OR stream_seq < first_open), 0) AS ack_floor,
    max(stream_seq) AS delivered_floor FROM deliveries LEFT JOIN u USING (split_id) GROUP BY split_id""", _P)
def ack_floor(spark: SparkSession, sf: str) -> DataFrame:
    return G.floors(deliveries(spark, sf), acks(spark, sf), n_splits(spark, sf))


@query("ack_pending_count", """SELECT split_id, count(DISTINCT stream_seq) FILTER
    ((split_id, stream_seq) NOT IN (SELECT (split_id, stream_seq) FROM acks)) AS ack_pending
  FROM deliveries GROUP BY split_id""", _P)
def ack_pending_count(spark: SparkSession, sf: str) -> DataFrame:
    return G.pending_count(deliveries(spark, sf), acks(spark, sf), "each")


@query("redeliver", """, last AS (SELECT split_id, stream_seq, max(attempt) AS attempt, max(delivered_at) AS last_at
    FROM deliveries GROUP BY split_id, stream_seq)
  SELECT split_id, stream_seq, attempt + 1 AS attempt FROM last
  WHERE (split_id, stream_seq) NOT IN (SELECT (split_id, stream_seq) FROM acks)
    AND last_at + INTERVAL 1 DAY <= TIMESTAMP '2024-01-25' AND attempt < 2""", _P)
def redeliver(spark: SparkSession, sf: str) -> DataFrame:
    return G.redeliver(deliveries(spark, sf), acks(spark, sf), instant("2024-01-25 00:00:00"), "1 DAY", max_deliver=2)


@query("redeliver_stream", """, last AS (SELECT split_id, stream_seq, max(attempt) AS attempt, max(delivered_at) AS last_at
    FROM deliveries GROUP BY split_id, stream_seq)
  SELECT split_id, stream_seq, attempt + 1 AS attempt FROM last
  WHERE (split_id, stream_seq) NOT IN (SELECT (split_id, stream_seq) FROM acks)
    AND date_trunc('milliseconds', last_at) + INTERVAL 1 DAY <= TIMESTAMP '2024-01-25' AND attempt < 2""", _P)
def redeliver_in_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same with state and timers: deliveries and acknowledgements are streams, time ends on the 25th."""
    path, now = shared_dir(spark, "redelivery"), instant("2024-01-25 00:00:00")
    told = deliveries(spark, sf).where(F.col("delivered_at") <= now).select(
        "split_id", "stream_seq", "attempt", F.col("delivered_at").cast("timestamp").alias("delivered_at"))
    clock = spark.range(1).select(F.lit("").alias("split_id"), F.lit(-1).cast("long").alias("stream_seq"), F.lit(0).alias("attempt"),
                                  now.cast("timestamp").alias("delivered_at"))
    told.unionByName(clock).write.parquet(f"{path}/deliveries")
    known = acks(spark, sf).withColumn("acked_at", instant("2024-01-20 00:00:00").cast("timestamp"))
    known.write.parquet(f"{path}/acks")
    due = redeliver_stream(spark.readStream.schema(told.schema).parquet(f"{path}/deliveries"),
                           spark.readStream.schema(known.schema).parquet(f"{path}/acks"), "1 DAY", max_deliver=2)
    flows.drain(due, f"{path}/rows", f"{path}/checkpoint")
    return spark.read.schema(due.schema).parquet(f"{path}/rows").select("split_id", "stream_seq", "attempt")


_Q = ("L", "S", "progress")


@query("resume_from_progress", """SELECT s.split_id, s.stream_seq FROM S s LEFT JOIN progress p USING (split_id)
  WHERE s.stream_seq > coalesce(last_seq, 0) AND coalesce(status, 'active') = 'active'""", _Q)
def resume_from_progress(spark: SparkSession, sf: str) -> DataFrame:
    return G.resume(split_log(spark, sf), progress(spark, sf), splits(spark, sf), n_splits(spark, sf), EVENT_SEQ).select("split_id", "stream_seq")


@query("pause_resume", """SELECT s.split_id, s.stream_seq FROM S s LEFT JOIN progress p USING (split_id)
  WHERE s.stream_seq > coalesce(last_seq, 0) AND s.event_type <> 'click'""", _Q)
def pause_resume(spark: SparkSession, sf: str) -> DataFrame:
    """`click` is paused and `view` resumed: what came meanwhile arrives, nothing is lost."""
    name = {row["filter"]: row.split_id for row in splits(spark, sf).collect()}
    state = G.set_status(progress(spark, sf), pause=(name["events.click.>"],), resume=(name["events.view.>"],))
    return G.resume(split_log(spark, sf), state, splits(spark, sf), n_splits(spark, sf), EVENT_SEQ).select("split_id", "stream_seq")


@query("progress_update", """, b AS (SELECT split_id, max(stream_seq) AS seen FROM S
    WHERE "timestamp" < TIMESTAMP '2024-01-20' AND event_type <> 'error' GROUP BY split_id)
  SELECT split_id, greatest(last_seq, seen) AS last_seq, coalesce(status, 'active') AS status
  FROM progress FULL JOIN b USING (split_id)""", _Q)
def progress_update(spark: SparkSession, sf: str) -> DataFrame:
    """A batch without `error` messages; `signup` appears for the first time."""
    batch = split_log(spark, sf).where((F.col("timestamp") < instant("2024-01-20 00:00:00"))
                                       & (F.col("event_type") != "error"))
    return G.update_progress(progress(spark, sf), batch)


@query("progress_subsume", """SELECT split_id, max(stream_seq) AS last_seq FROM S
  WHERE "timestamp" < TIMESTAMP '2024-01-19' GROUP BY split_id""", ("L", "S"))
def progress_subsume(spark: SparkSession, sf: str) -> DataFrame:
    """One epoch per day; the 18th is the last completed one and covers all before it."""
    history = (split_log(spark, sf).withColumn("epoch", F.date_diff(F.col("timestamp").cast("date"), F.lit("1970-01-01").cast("date")).cast("long"))
               .groupBy("split_id", "epoch").agg(F.max("stream_seq").alias("last_seq")))
    return G.completed_progress(history, (date(2024, 1, 18) - date(1970, 1, 1)).days)


@query("unread_filters", """SELECT DISTINCT s."filter" FROM S s WHERE split_id NOT IN (SELECT split_id FROM progress)""", _Q)
def unread_filters(spark: SparkSession, sf: str) -> DataFrame:
    current = with_split(discover_filters(log(spark, sf), depth=2), "consumer")
    return unread(current, progress(spark, sf)).select("filter")


# --- flow statistics -------------------------------------------------------------------------------------

@query("flow_in", """SELECT stream, count(*) AS n_records, CAST(sum(octet_length(encode(props))) AS BIGINT) AS n_bytes,
  count(DISTINCT split_id) AS n_consumers FROM S GROUP BY stream""", ("L", "S"))
def flow_in(spark: SparkSession, sf: str) -> DataFrame:
    return stats.flow_in(split_log(spark, sf))


@query("flow_sizes", """SELECT stream, subject, count(*) AS n_records, CAST(min(octet_length(encode(text))) AS BIGINT) AS min_bytes,
  CAST(max(octet_length(encode(text))) AS BIGINT) AS max_bytes, avg(octet_length(encode(text))) AS avg_bytes
  FROM D GROUP BY stream, subject""", ("D",))
def flow_sizes(spark: SparkSession, sf: str) -> DataFrame:
    sizes = stats.flow_sizes(documents_log(spark, sf), ["stream", "subject"])
    return sizes.withColumn("min_bytes", F.col("min_bytes").cast("long")).withColumn("max_bytes", F.col("max_bytes").cast("long"))
