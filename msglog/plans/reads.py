"""Queries on scans, positions, discovery, decoding, metadata, predicates and limits."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msglog.functions import headers as H
from msglog.functions import metadata as M
from msglog.functions import payload as P
from msglog.functions import subjects as S
from msglog.operators import discovery, positions
from msglog.operators.progress import delivered_count
from msglog.operators.sequence import first_n, running_max
from msglog.operators.splits import (FilterSet, match_filters, match_splits, multi_match, overlap_classes, overlapping, share, union_all,
                                     values)
from msglog.operators.stats import last_message, last_per_subject, stream_info
from msglog.plans.catalog import query
from msglog.plans.inputs import (PAYLOAD, compressing, deliveries, k_of, log, n_splits, share_of_log, split_log,
                                 type_filters)
from msglog.sources.adapters import (EVENT_SEQ, EVENT_TOKENS, ORDER_TOKENS, documents_log, events_log, events_stream, orders_log,
                                     table)
from msglog.schema import ENVELOPE
from msglog.sources.log import create_log_view, read_log
from msglog.sources.store import saved, shared_dir
from msglog.streaming.flows import drain

ENVELOPE_COLUMNS = [f.name for f in ENVELOPE.fields]
MID_JANUARY_MS = 1_705_276_800_000  # 2024-01-15 00:00:00 UTC


# --- scans -----------------------------------------------------------------

@query("scan_batch", 'SELECT props AS value, subject, stream_seq AS "streamSeq", "timestamp" FROM L')
def scan_batch(spark: SparkSession, sf: str) -> DataFrame:
    return read_log(spark, frame=log(spark, sf), stream="events",
                    metadata=["subject", "streamSeq", "timestamp"])


@query("scan_stream", 'SELECT props AS value, subject, stream_seq AS "streamSeq", "timestamp" FROM L')
def scan_stream(spark: SparkSession, sf: str) -> DataFrame:
    stream = read_log(spark, frame=events_stream(spark, sf), stop=("never",),
                      metadata=["subject", "streamSeq", "timestamp"])
    out = shared_dir(spark, "scan")
    drain(stream, f"{out}/rows", f"{out}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


@query("scan_stream_batches",
       "SELECT event_type, count(*) AS n, max(stream_seq) AS last_seq FROM L GROUP BY event_type")
def scan_stream_batches(spark: SparkSession, sf: str) -> DataFrame:
    stream = events_stream(spark, sf, max_files=1).select("event_type", "stream_seq")
    out = shared_dir(spark, "scan")
    drain(stream, f"{out}/rows", f"{out}/checkpoint")
    return (spark.read.schema(stream.schema).parquet(f"{out}/rows")
            .groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("stream_seq").alias("last_seq")))


@query("sql_view", """SELECT subject, k, stream_seq AS "streamSeq" FROM L
  WHERE subject LIKE 'events.click.%' AND k >= 50""")
def sql_view(spark: SparkSession, sf: str) -> DataFrame:
    view = f"log_{uuid.uuid4().hex}"
    create_log_view(spark, view, frame=log(spark, sf), format="json", schema=PAYLOAD,
                    metadata=["subject", "streamSeq"])
    return spark.sql(f"SELECT subject, k, streamSeq FROM {view} WHERE subject LIKE 'events.click.%' AND k >= 50")


@query("scan_default_splits", 'SELECT stream_seq, subject, "filter", split_id FROM S', ("L", "S"))
def scan_default_splits(spark: SparkSession, sf: str) -> DataFrame:
    source = log(spark, sf)
    registry = saved(discovery.discover_filters(source, depth=2), "registry")
    chosen = FilterSet.of(spark, registry.select("filter"))
    return match_splits(source, chosen, "consumer") \
        .select("stream_seq", "subject", "filter", "split_id")


@query("scan_filters", """SELECT "filter", count(*) AS n, min(stream_seq) AS first_seq, max(stream_seq) AS last_seq
  FROM S GROUP BY "filter" """, ("L", "S"))
def scan_filters(spark: SparkSession, sf: str) -> DataFrame:
    return split_log(spark, sf).groupBy("filter").agg(
        F.count(F.lit(1)).alias("n"), F.min("stream_seq").alias("first_seq"), F.max("stream_seq").alias("last_seq"))


@query("subject_match_star",
       "SELECT stream_seq, subject FROM L WHERE regexp_full_match(subject, 'events\\.[^.]+\\.7')")
def subject_match_star(spark: SparkSession, sf: str) -> DataFrame:
    return log(spark, sf).where(S.matches("events.*.7", tokens=EVENT_TOKENS)).select("stream_seq", "subject")


@query("subject_match_tail", "SELECT stream_seq, subject FROM L WHERE starts_with(subject, 'events.click.')")
def subject_match_tail(spark: SparkSession, sf: str) -> DataFrame:
    return log(spark, sf).where(S.matches("events.click.>", tokens=EVENT_TOKENS)).select("stream_seq", "subject")


@query("headers_only", """SELECT subject, count(*) AS n, CAST(sum(octet_length(encode(props))) AS BIGINT) AS n_bytes
  FROM L GROUP BY subject""")
def headers_only(spark: SparkSession, sf: str) -> DataFrame:
    return (read_log(spark, frame=log(spark, sf), headers_only=True, metadata=["subject"])
            .groupBy("subject").agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("n_bytes")))


@query("stream_info", """, A AS (SELECT stream, subject, stream_seq FROM L UNION ALL
  SELECT stream, subject, stream_seq FROM O UNION ALL SELECT stream, subject, stream_seq FROM D)
  SELECT stream, count(*) AS n_messages, min(stream_seq) AS first_seq, max(stream_seq) AS last_seq,
    count(DISTINCT subject) AS n_subjects FROM A GROUP BY stream""", ("L", "O", "D"))
def stream_info_query(spark: SparkSession, sf: str) -> DataFrame:
    return stream_info(_all_logs(spark, sf))


def _all_logs(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["stream", "subject", "stream_seq"]
    return (log(spark, sf).select(*columns).unionByName(orders_log(spark, sf).select(*columns))
            .unionByName(documents_log(spark, sf).select(*columns)))


@query("last_per_subject", """SELECT subject, max(stream_seq) AS stream_seq, arg_max(props, stream_seq) AS value
  FROM L GROUP BY subject""")
def last_per_subject_query(spark: SparkSession, sf: str) -> DataFrame:
    return last_per_subject(log(spark, sf), ["data"]).select("subject", "stream_seq", P.text(F.col("data")).alias("value"))


@query("last_message", "SELECT subject, stream_seq, props AS value FROM L ORDER BY stream_seq DESC LIMIT 1")
def last_message_query(spark: SparkSession, sf: str) -> DataFrame:
    return last_message(log(spark, sf)).select("subject", "stream_seq", P.text(F.col("data")).alias("value"))


# --- start and stop positions ----------------------------------------------

def _from(spark: SparkSession, sf: str, rule: tuple, snapshot: int | None = None) -> DataFrame:
    return positions.start_at(log(spark, sf), rule, snapshot, EVENT_SEQ).select("stream_seq", "subject")


@query("start_earliest", "SELECT stream_seq, subject FROM L")
def start_earliest(spark: SparkSession, sf: str) -> DataFrame:
    return _from(spark, sf, ("earliest",))


@query("start_latest", "SELECT stream_seq, subject FROM L WHERE stream_seq > (SELECT max(stream_seq) // 2 FROM L)")
def start_latest(spark: SparkSession, sf: str) -> DataFrame:
    return _from(spark, sf, ("latest",), snapshot=share_of_log(log(spark, sf), 1, 2))


@query("start_time", "SELECT stream_seq, subject FROM L WHERE \"timestamp\" >= TIMESTAMP '2024-01-15'")
def start_time(spark: SparkSession, sf: str) -> DataFrame:
    return _from(spark, sf, ("time", MID_JANUARY_MS))


@query("start_seq", "SELECT stream_seq, subject FROM L WHERE stream_seq >= (SELECT max(stream_seq) // 3 FROM L)")
def start_seq(spark: SparkSession, sf: str) -> DataFrame:
    return _from(spark, sf, ("seq", share_of_log(log(spark, sf), 1, 3)))


@query("stop_latest", "SELECT stream_seq, subject FROM L WHERE stream_seq <= (SELECT max(stream_seq) FROM L)")
def stop_latest(spark: SparkSession, sf: str) -> DataFrame:
    source = log(spark, sf)
    return positions.stop_at(source, ("latest",), snapshot=positions.last_seq(source), seq=EVENT_SEQ) \
        .select("stream_seq", "subject")


@query("stop_seq", """, cuts AS (SELECT split_id, min(stream_seq) AS cut FROM S
    WHERE stream_seq >= (SELECT max(stream_seq) * 2 // 5 FROM L) GROUP BY split_id)
  SELECT split_id, stream_seq FROM S LEFT JOIN cuts USING (split_id) WHERE cut IS NULL OR stream_seq <= cut""",
       ("L", "S"))
def stop_seq(spark: SparkSession, sf: str) -> DataFrame:
    rule = ("seq", share_of_log(log(spark, sf), 2, 5))
    return positions.stop_at(split_log(spark, sf), rule, "split_id", n_splits(spark, sf), seq=EVENT_SEQ, one_stream=True) \
        .select("split_id", "stream_seq")


@query("stop_time", """, cuts AS (SELECT split_id, min(stream_seq) AS cut FROM S
    WHERE "timestamp" >= TIMESTAMP '2024-01-15' GROUP BY split_id)
  SELECT split_id, stream_seq FROM S LEFT JOIN cuts USING (split_id) WHERE cut IS NULL OR stream_seq <= cut""",
       ("L", "S"))
def stop_time(spark: SparkSession, sf: str) -> DataFrame:
    return positions.stop_at(split_log(spark, sf), ("time", MID_JANUARY_MS), "split_id", n_splits(spark, sf), seq=EVENT_SEQ, one_stream=True) \
        .select("split_id", "stream_seq")


@query("stop_count", """SELECT stream_seq, subject FROM L ORDER BY stream_seq
  LIMIT (SELECT max(stream_seq) // 4 FROM L)""")
def stop_count(spark: SparkSession, sf: str) -> DataFrame:
    rule = ("count", share_of_log(log(spark, sf), 1, 4))
    return positions.stop_at(log(spark, sf), rule, seq=EVENT_SEQ, one_stream=True).select("stream_seq", "subject")


@query("split_finished", """, cuts AS (SELECT split_id, min(stream_seq) AS cut FROM S
    WHERE stream_seq >= (SELECT max(stream_seq) - 5 FROM L) GROUP BY split_id)
  SELECT split_id, count(*) AS n_read, max(stream_seq) AS last_read, bool_or(cut IS NOT NULL) AS finished
  FROM S LEFT JOIN cuts USING (split_id) WHERE cut IS NULL OR stream_seq <= cut GROUP BY split_id""", ("L", "S"))
def split_finished(spark: SparkSession, sf: str) -> DataFrame:
    rule = ("seq", positions.last_seq(log(spark, sf)) - 5)
    return positions.finished(split_log(spark, sf), rule, "split_id", n_splits(spark, sf), EVENT_SEQ)


@query("boundedness", """, T AS (SELECT max(stream_seq) AS last FROM L)
  SELECT 'never' AS rule, false AS bounded, count(*) AS n FROM L
  UNION ALL SELECT 'latest', true, count(*) FROM L
  UNION ALL SELECT 'seq', true, count(*) FROM L, T WHERE stream_seq <= last // 2
  UNION ALL SELECT 'count', true, count(*) FROM (
    SELECT stream_seq FROM L ORDER BY stream_seq LIMIT (SELECT last // 2 FROM T))
  UNION ALL SELECT 'time', true, count(*) FROM L WHERE stream_seq <= (
    SELECT min(stream_seq) FROM L WHERE "timestamp" >= TIMESTAMP '2024-01-15')""")
def boundedness(spark: SparkSession, sf: str) -> DataFrame:
    """The same log under every stop rule: only ``never`` yields a streaming read."""
    half = share_of_log(log(spark, sf), 1, 2)
    rules = [("never",), ("latest",), ("seq", half), ("count", half), ("time", MID_JANUARY_MS)]
    parts = []
    for rule in rules:
        source = log(spark, sf) if positions.is_bounded(rule) else events_stream(spark, sf)
        read = read_log(spark, frame=source, stop=rule, seq=EVENT_SEQ, metadata=["streamSeq"]).select("streamSeq")
        bounded = not read.isStreaming
        if not bounded:
            out = shared_dir(spark, "scan")
            drain(read, f"{out}/rows", f"{out}/checkpoint")
            read = spark.read.schema(read.schema).parquet(f"{out}/rows")
        parts.append(read.agg(F.count(F.lit(1)).alias("n"))
                     .select(F.lit(rule[0]).alias("rule"), F.lit(bounded).alias("bounded"), "n"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# --- discovery ---------------------------------------------------------------

@query("discover_filters", """, A AS (SELECT stream, subject FROM L UNION ALL
  SELECT stream, subject FROM O UNION ALL SELECT stream, subject FROM D)
  SELECT DISTINCT stream, split_part(subject, '.', 1) || '.' || split_part(subject, '.', 2) || '.>' AS "filter" FROM A""",
       ("L", "O", "D"))
def discover_filters_query(spark: SparkSession, sf: str) -> DataFrame:
    return discovery.discover_filters(_all_logs(spark, sf), depth=2)


def _daily_filters(spark: SparkSession, sf: str) -> DataFrame:
    days = log(spark, sf).select("stream", F.col("subject").alias("filter"), F.to_date("timestamp").alias("day"))
    return days.distinct()


_DAYS = """, days AS (SELECT DISTINCT stream, subject AS "filter", CAST("timestamp" AS DATE) AS d FROM L)"""


@query("splits_added", _DAYS + """ SELECT stream, "filter", strftime(d, '%Y-%m-%d') AS day FROM
  (SELECT stream, "filter", d FROM days EXCEPT SELECT stream, "filter", CAST(d + INTERVAL 1 DAY AS DATE) FROM days)""")
def splits_added(spark: SparkSession, sf: str) -> DataFrame:
    """Filters each day's look-up finds that the day before did not have."""
    today = _daily_filters(spark, sf)
    before = today.withColumn("day", F.date_add("day", 1))
    return discovery.added(before, today, ("stream", "filter", "day")) \
        .select("stream", "filter", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("splits_revoked", _DAYS + """ SELECT stream, "filter", strftime(d, '%Y-%m-%d') AS day FROM
  (SELECT stream, "filter", CAST(d + INTERVAL 1 DAY AS DATE) AS d FROM days EXCEPT SELECT stream, "filter", d FROM days)""")
def splits_revoked(spark: SparkSession, sf: str) -> DataFrame:
    """Filters of the day before that each day's look-up no longer finds."""
    today = _daily_filters(spark, sf)
    before = today.withColumn("day", F.date_add("day", 1))
    return discovery.revoked(before, today, ("stream", "filter", "day")) \
        .select("stream", "filter", F.date_format("day", "yyyy-MM-dd").alias("day"))


_HISTORY = """, M AS (SELECT max(stream_seq) // 2 AS mid FROM L),
  early AS (SELECT DISTINCT stream, subject AS "filter" FROM L, M WHERE stream_seq <= mid),
  late AS (SELECT DISTINCT stream, subject AS "filter" FROM L, M WHERE stream_seq > mid AND event_type <> 'error'),
  registry AS (
    SELECT e.stream, e."filter", CAST(1 AS BIGINT) AS from_seq,
      CASE WHEN l."filter" IS NULL THEN (SELECT mid + 1 FROM M) END AS to_seq
    FROM early e LEFT JOIN late l USING (stream, "filter")
    UNION ALL
    SELECT stream, "filter", (SELECT mid + 1 FROM M), NULL
    FROM (SELECT * FROM late EXCEPT SELECT * FROM early))"""


def _registry(spark: SparkSession, sf: str) -> DataFrame:
    """A registry filled from the first half of the log and brought up to date with the
    second, where ``error`` subjects are withdrawn."""
    source = log(spark, sf)
    mid = share_of_log(source, 1, 2)
    first_half, second_half = positions.seq_to(source, mid, EVENT_SEQ), positions.seq_from(source, mid + 1, EVENT_SEQ)
    early = saved(discovery.discover_filters(source.where(first_half), depth=3), "registry")
    late = saved(discovery.discover_filters(source.where(second_half & (F.col("event_type") != "error")), depth=3),
                 "registry")
    first = early.select("stream", "filter", F.lit(1).cast("long").alias("from_seq"),
                         F.lit(None).cast("long").alias("to_seq"))
    return discovery.update_registry(first, late, mid + 1)


@query("registry_update", _HISTORY + 'SELECT stream, "filter", from_seq, to_seq FROM registry')
def registry_update(spark: SparkSession, sf: str) -> DataFrame:
    return _registry(spark, sf)


@query("scan_filter_history", _HISTORY + """SELECT stream_seq, "filter" FROM L JOIN registry ON subject = "filter"
  WHERE stream_seq >= from_seq AND (to_seq IS NULL OR stream_seq < to_seq)""")
def scan_filter_history(spark: SparkSession, sf: str) -> DataFrame:
    registry = saved(_registry(spark, sf), "registry")
    return discovery.scan_history(spark, log(spark, sf), registry).select("stream_seq", "filter")


def _mixed_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Filters of every form for the subjects of the log: per type, per user, per subject."""
    words = log(spark, sf).select("event_type", "user_id", "subject")
    forms = F.array(F.concat(F.lit("events."), "event_type", F.lit(".>")),
                    F.concat(F.lit("events.*."), F.col("user_id").cast("string")), F.col("subject"))
    return words.select(F.explode(forms).alias("filter")).distinct()


_MIXED = """, F AS (SELECT DISTINCT unnest(['events.' || event_type || '.>', 'events.*.' || user_id, subject]) AS f FROM L)"""


@query("filters_overlap", _MIXED + """, W AS (SELECT f, string_split(f, '.') AS w FROM F)
  SELECT a.f AS a, b.f AS b FROM W a JOIN W b ON a.f < b.f
    AND (a.w[2] = b.w[2] OR '*' IN (a.w[2], b.w[2]))
    AND (a.w[3] = b.w[3] OR '>' IN (a.w[3], b.w[3]))""")
def filters_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return overlapping(FilterSet.of(spark, saved(_mixed_filters(spark, sf), "filters")))


@query("filters_overlap_classes", _MIXED + """, W AS (SELECT f, string_split(f, '.') AS w FROM F),
  P AS (SELECT a.f AS a, b.f AS b FROM W a JOIN W b ON a.f <> b.f AND (a.w[2] = b.w[2] OR '*' IN (a.w[2], b.w[2]))
    AND (a.w[3] = b.w[3] OR '>' IN (a.w[3], b.w[3])))
  SELECT f AS "filter", (SELECT min(f) FROM F) AS class, count(b) AS n_overlaps FROM F LEFT JOIN P ON a = f GROUP BY f""")
def filters_overlap_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Every user's filter meets every type's, so the filters are one class."""
    return overlap_classes(FilterSet.of(spark, saved(_mixed_filters(spark, sf), "filters"))).select("filter", "class", "n_overlaps")


@query("multi_match", """, F AS (SELECT DISTINCT 'events.*.' || user_id AS f, '^events\\.[^.]+\\.' || user_id || '$' AS p FROM L
    UNION ALL SELECT 'events.click.>', '^events\\.click\\..+$' UNION ALL SELECT 'events.view.>', '^events\\.view\\..+$')
  SELECT stream, stream_seq, count(*) AS n_filters FROM L JOIN F ON regexp_matches(subject, p)
  GROUP BY stream, stream_seq HAVING count(*) > 1""")
def multi_match_query(spark: SparkSession, sf: str) -> DataFrame:
    source = log(spark, sf)
    per_user = source.select(F.concat(F.lit("events.*."), F.col("user_id").cast("string")).alias("filter")).distinct()
    per_type = values(spark, [{"filter": "events.click.>"}, {"filter": "events.view.>"}])
    filters = saved(per_user.unionByName(per_type), "filters")
    return multi_match(match_filters(source, FilterSet.of(spark, filters)))


@query("consumer_name", _MIXED + """ SELECT f AS "filter", 'job-' || substr(md5(f), 1, 5) AS consumer FROM F""")
def consumer_name(spark: SparkSession, sf: str) -> DataFrame:
    return _mixed_filters(spark, sf).withColumn("consumer", S.consumer_name("job", F.col("filter")))


@query("split_id", _MIXED + """ SELECT f AS "filter", 'events > job-' || substr(md5(f), 1, 5) AS split_id FROM F""")
def split_id(spark: SparkSession, sf: str) -> DataFrame:
    name = S.consumer_name("job", F.col("filter"))
    return _mixed_filters(spark, sf).withColumn("split_id", S.split_id(F.lit("events"), name))


# --- decoding ------------------------------------------------------------------

@query("decode_string", "SELECT stream_seq, props AS value FROM L")
def decode_string(spark: SparkSession, sf: str) -> DataFrame:
    return log(spark, sf).select("stream_seq", P.text(F.col("data")).alias("value"))


@query("decode_json", 'SELECT k, stream_seq AS "streamSeq" FROM L')
def decode_json(spark: SparkSession, sf: str) -> DataFrame:
    return read_log(spark, frame=log(spark, sf), format="json", schema=PAYLOAD, metadata=["streamSeq"])


@query("decode_csv", "SELECT o_orderkey, o_orderstatus, o_totalprice, stream_seq FROM O", ("O",))
def decode_csv(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders")
    messages = rows.select((F.col("o_orderkey") + 1).alias("stream_seq"),
                           P.encoded("csv", ["o_orderkey", "o_orderstatus", "o_totalprice"]).alias("data"))
    schema = "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE"
    return messages.select(P.parsed(F.col("data"), "csv", schema).alias("p"), "stream_seq").select("p.*", "stream_seq")


@query("decode_bad_split", """SELECT stream, false AS bad, count(*) AS n, CAST(sum(k) AS BIGINT) AS sum_k FROM L GROUP BY stream
  UNION ALL SELECT stream, true, count(*), NULL FROM D GROUP BY stream""", ("L", "D"))
def decode_bad_split(spark: SparkSession, sf: str) -> DataFrame:
    """JSON payloads of one log and plain text of another, told apart."""
    both = log(spark, sf).select("stream", "data").unionByName(documents_log(spark, sf).select("stream", "data"))
    good, bad = P.split_bad(both, PAYLOAD)
    counted = good.groupBy("stream").agg(F.count(F.lit(1)).alias("n"), F.sum("payload.k").alias("sum_k")) \
        .withColumn("bad", F.lit(False))
    failed = bad.groupBy("stream").agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("long").alias("sum_k")) \
        .withColumn("bad", F.lit(True))
    return counted.unionByName(failed).select("stream", "bad", "n", "sum_k")


@query("decode_udf", "SELECT stream_seq, subject, text AS value FROM D", ("D",))
def decode_udf(spark: SparkSession, sf: str) -> DataFrame:
    """A custom decoder for compressed payloads, exchanged in Arrow batches."""
    deflate, inflate = compressing()
    packed = documents_log(spark, sf).withColumn("data", deflate(P.text(F.col("data"))))
    return packed.select("stream_seq", "subject", P.parsed(F.col("data"), inflate).alias("value"))


# --- metadata --------------------------------------------------------------------

@query("meta_core", 'SELECT subject, stream, CAST(NULL AS VARCHAR) AS domain, stream_seq AS "streamSeq", "timestamp" FROM L')
def meta_core(spark: SparkSession, sf: str) -> DataFrame:
    return M.project(log(spark, sf), [], ["subject", "stream", "domain", "streamSeq", "timestamp"])


@query("meta_headers", """SELECT stream_seq, event_type, CAST(user_id AS VARCHAR) AS user_name, 2 AS n_headers,
  CAST(NULL AS VARCHAR) AS missing FROM L""")
def meta_headers(spark: SparkSession, sf: str) -> DataFrame:
    read = M.project(log(spark, sf), ["stream_seq"], ["headers"])
    h = F.col("headers")
    return read.select("stream_seq", H.first_value(h, "event-type").alias("event_type"),
                       H.first_value(h, "user").alias("user_name"), F.size(h).alias("n_headers"),
                       H.first_value(h, "none").alias("missing"))


@query("meta_consumer", "SELECT stream_seq, consumer FROM S", ("L", "S"))
def meta_consumer(spark: SparkSession, sf: str) -> DataFrame:
    return M.project(split_log(spark, sf), ["stream_seq"], ["consumer"])


@query("meta_delivered", "SELECT split_id, stream_seq, count(*) AS delivered FROM deliveries GROUP BY split_id, stream_seq",
       ("L", "S", "deliveries"))
def meta_delivered(spark: SparkSession, sf: str) -> DataFrame:
    return delivered_count(deliveries(spark, sf))


@query("meta_consumer_seq", """SELECT consumer, stream_seq AS "streamSeq",
  row_number() OVER (PARTITION BY consumer ORDER BY stream_seq) AS "consumerSeq" FROM S""", ("L", "S"))
def meta_consumer_seq(spark: SparkSession, sf: str) -> DataFrame:
    return read_log(spark, frame=log(spark, sf), filters=type_filters(spark, sf), tokens=EVENT_TOKENS,
                    metadata=["consumer", "streamSeq", "consumerSeq"]).drop("value")


@query("meta_pending", """SELECT consumer, stream_seq AS "streamSeq", count(*) OVER (PARTITION BY consumer)
  - row_number() OVER (PARTITION BY consumer ORDER BY stream_seq) AS pending FROM S""", ("L", "S"))
def meta_pending(spark: SparkSession, sf: str) -> DataFrame:
    return read_log(spark, frame=log(spark, sf), filters=type_filters(spark, sf), tokens=EVENT_TOKENS,
                    metadata=["consumer", "streamSeq", "pending"]).drop("value")


@query("meta_local_time", """SELECT stream_seq, epoch_us("timestamp" + CASE event_type WHEN 'click' THEN INTERVAL 9 HOUR
  WHEN 'view' THEN INTERVAL (-5) HOUR ELSE INTERVAL 0 HOUR END) // 1000 AS local_ms FROM L""")
def meta_local_time(spark: SparkSession, sf: str) -> DataFrame:
    zone = (F.when(F.col("event_type") == "click", "Asia/Tokyo")
            .when(F.col("event_type") == "view", "America/New_York").otherwise("UTC"))
    zoned = log(spark, sf).withColumn("timezone", zone)
    local = M.local_time(F.col("timestamp"), F.col("timezone"))
    return zoned.select("stream_seq", F.unix_millis(local).alias("local_ms"))


@query("project_metadata", """SELECT k, subject AS message_subject, stream, stream_seq AS seq FROM L""")
def project_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return read_log(spark, frame=log(spark, sf), format="json", schema=PAYLOAD,
                    metadata=["subject", "stream", "streamSeq"],
                    names={"subject": "message_subject", "streamSeq": "seq"})


@query("event_time", 'SELECT stream_seq, epoch_us("timestamp") // 1000 AS event_ms FROM L')
def event_time(spark: SparkSession, sf: str) -> DataFrame:
    return log(spark, sf).select("stream_seq", F.unix_micros(M.event_time(F.col("timestamp"))).alias("us")) \
        .select("stream_seq", F.expr("us div 1000").alias("event_ms"))


# --- predicates --------------------------------------------------------------------

def _where(spark: SparkSession, sf: str, condition) -> DataFrame:
    return log(spark, sf).where(condition).select("stream_seq", "subject")


def _predicate(name: str, condition: str):
    return query(name, f"SELECT stream_seq, subject FROM L WHERE {condition}")


@_predicate("pred_eq", "subject = 'events.click.7'")
def pred_eq(spark: SparkSession, sf: str) -> DataFrame:
    return _where(spark, sf, S.subject_eq("events.click.7", tokens=EVENT_TOKENS))


@_predicate("pred_like_prefix", "subject LIKE 'events.click.%'")
def pred_like_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return _where(spark, sf, S.subject_like("events.click.%", tokens=EVENT_TOKENS))


@_predicate("pred_like_underscore", "subject LIKE 'events._iew.1_'")
def pred_like_underscore(spark: SparkSession, sf: str) -> DataFrame:
    return _where(spark, sf, S.subject_like("events._iew.1_", tokens=EVENT_TOKENS))


@_predicate("pred_like_suffix", "subject LIKE '%.7'")
def pred_like_suffix(spark: SparkSession, sf: str) -> DataFrame:
    return _where(spark, sf, S.subject_like("%.7", tokens=EVENT_TOKENS))


@_predicate("pred_in", "subject IN ('events.click.7', 'events.view.3', 'events.error.11')")
def pred_in(spark: SparkSession, sf: str) -> DataFrame:
    return _where(spark, sf, S.subject_in(["events.click.7", "events.view.3", "events.error.11"], tokens=EVENT_TOKENS))


@_predicate("pred_or", "subject = 'events.click.7' OR subject IN ('events.view.3', 'events.error.11')")
def pred_or(spark: SparkSession, sf: str) -> DataFrame:
    return _where(spark, sf, S.subject_eq("events.click.7", tokens=EVENT_TOKENS)
                  | S.subject_in(["events.view.3", "events.error.11"], tokens=EVENT_TOKENS))


@_predicate("pred_reversed", "'events.click.7' = subject")
def pred_reversed(spark: SparkSession, sf: str) -> DataFrame:
    return _where(spark, sf, F.lit("events.click.7") == F.col("subject"))


@query("pred_partial", "SELECT stream_seq, k FROM L WHERE subject LIKE 'events.click.%' AND k >= 50")
def pred_partial(spark: SparkSession, sf: str) -> DataFrame:
    chosen = log(spark, sf).where(S.subject_like("events.click.%", tokens=EVENT_TOKENS))
    return chosen.select("stream_seq", k_of().alias("k")).where(F.col("k") >= 50)


@_predicate("pred_upper", "upper(subject) = 'EVENTS.CLICK.7'")
def pred_upper(spark: SparkSession, sf: str) -> DataFrame:
    return _where(spark, sf, F.upper("subject") == "EVENTS.CLICK.7")


@_predicate("pred_in_column", "subject IN ('events.click.' || user_id, 'events.view.' || k)")
def pred_in_column(spark: SparkSession, sf: str) -> DataFrame:
    user = F.concat(F.lit("events.click."), F.col("user_id").cast("string"))
    return _where(spark, sf, F.col("subject").isin(user, F.concat(F.lit("events.view."), k_of().cast("string"))))


@_predicate("pred_concat", "subject = 'events.' || 'click.7'")
def pred_concat(spark: SparkSession, sf: str) -> DataFrame:
    return _where(spark, sf, F.col("subject") == F.concat(F.lit("events."), F.lit("click.7")))


@query("pred_with_config", """SELECT stream_seq AS "streamSeq", subject FROM L
  WHERE event_type IN ('click', 'view') AND subject LIKE '%.7'""")
def pred_with_config(spark: SparkSession, sf: str) -> DataFrame:
    read = read_log(spark, frame=log(spark, sf), filters=["events.click.>", "events.view.>"], tokens=EVENT_TOKENS,
                    metadata=["streamSeq", "subject"])
    return read.where(S.subject_like("%.7")).select("streamSeq", "subject")


# --- limits and event time ------------------------------------------------------------

@query("limit_scan", """SELECT k, subject, stream_seq AS "streamSeq" FROM L ORDER BY stream_seq LIMIT 10""")
def limit_scan(spark: SparkSession, sf: str) -> DataFrame:
    return read_log(spark, frame=log(spark, sf), format="json", schema=PAYLOAD, limit=10, seq=EVENT_SEQ,
                    metadata=["subject", "streamSeq"])


@query("limit_filtered", """SELECT k, stream_seq FROM L WHERE subject LIKE 'events.click.%' ORDER BY stream_seq LIMIT 10""")
def limit_filtered(spark: SparkSession, sf: str) -> DataFrame:
    chosen = log(spark, sf).where(S.subject_like("events.click.%", tokens=EVENT_TOKENS))
    return first_n(chosen, 10, physical=EVENT_SEQ).select(k_of().alias("k"), "stream_seq")


_ALL = """, A AS (SELECT stream, subject, stream_seq FROM L UNION ALL
  SELECT stream, subject, stream_seq FROM O UNION ALL SELECT stream, subject, stream_seq FROM D)"""


def _envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """The events, orders and documents logs together."""
    return union_all([events_log(spark, sf).select(*ENVELOPE_COLUMNS), orders_log(spark, sf).select(*ENVELOPE_COLUMNS),
                      documents_log(spark, sf).select(*ENVELOPE_COLUMNS)])


@query("limit_many_streams", _ALL + """ SELECT stream, stream_seq, subject FROM A ORDER BY stream_seq, stream LIMIT 1001""",
       ("L", "O", "D"))
def limit_many_streams(spark: SparkSession, sf: str) -> DataFrame:
    """A limit over streams whose sequences meet: exactly so many rows."""
    return read_log(spark, frame=_envelopes(spark, sf), limit=1001, headers_only=True,
                    metadata=["stream", "streamSeq", "subject"]).select("stream", F.col("streamSeq").alias("stream_seq"), "subject")


@query("stop_seq_many_streams", _ALL + """, E AS (SELECT *, CASE WHEN stream = 'docs' THEN 'docs.>' ELSE stream || '.>' END AS f FROM A),
  C AS (SELECT stream, f, min(stream_seq) FILTER (stream_seq >= 777) AS cut FROM E GROUP BY stream, f)
  SELECT E.stream, count(*) AS n, max(stream_seq) AS last_seq FROM E JOIN C USING (stream, f)
  WHERE cut IS NULL OR stream_seq <= cut GROUP BY E.stream""", ("L", "O", "D"))
def stop_seq_many_streams(spark: SparkSession, sf: str) -> DataFrame:
    """Each split of each stream stops after its own first message at or past the stop."""
    read = read_log(spark, frame=_envelopes(spark, sf), filters=["events.>", "orders.>", "docs.>"], stop=("seq", 777),
                    headers_only=True, metadata=["stream", "streamSeq"])
    return read.groupBy("stream").agg(F.count(F.lit(1)).alias("n"), F.max("streamSeq").alias("last_seq"))


def _scoped(spark: SparkSession, sf: str) -> DataFrame:
    """A registry over three streams: of orders only the first half of a filter's life counts, and
    the catch-all filter holds for documents alone."""
    half = F.lit(share_of_log(orders_log(spark, sf), 1, 2)).cast("long")
    rows = [{"stream": "events", "filter": "events.click.>"}, {"stream": "orders", "filter": "orders.F.>"},
            {"stream": "docs", "filter": ">"}]
    return values(spark, rows).withColumn("from_seq", F.lit(0).cast("long")) \
        .withColumn("to_seq", F.when(F.col("stream") == "orders", half))


_SCOPED = _ALL + """, H AS (SELECT max(stream_seq) // 2 AS half FROM O)
  SELECT stream, count(*) AS n, max(stream_seq) AS last_seq FROM A, H
  WHERE (stream = 'events' AND starts_with(subject, 'events.click.')) OR stream = 'docs'
    OR (stream = 'orders' AND starts_with(subject, 'orders.F.') AND stream_seq < half) GROUP BY stream"""


@query("scan_registry_streams", _SCOPED, ("L", "O", "D"))
def scan_registry_streams(spark: SparkSession, sf: str) -> DataFrame:
    """Default filters hold for their own stream and time, and may be listed twice."""
    registry = _scoped(spark, sf)
    read = read_log(spark, frame=_envelopes(spark, sf), registry=registry.union(registry), headers_only=True,
                    metadata=["stream", "streamSeq"])
    return read.groupBy("stream").agg(F.count(F.lit(1)).alias("n"), F.max("streamSeq").alias("last_seq"))


@query("scan_registry_withdrawn", _ALL + """, H AS (SELECT max(stream_seq) // 2 AS half FROM O)
  SELECT stream, stream_seq FROM A, H WHERE stream = 'orders' AND starts_with(subject, 'orders.F.') AND stream_seq < half""",
       ("L", "O", "D"))
def scan_registry_withdrawn(spark: SparkSession, sf: str) -> DataFrame:
    """A withdrawn filter delivers what was stored before it was withdrawn, and nothing after."""
    registry = _scoped(spark, sf).where(F.col("to_seq").isNotNull())
    read = read_log(spark, frame=_envelopes(spark, sf), registry=registry, headers_only=True, metadata=["stream", "streamSeq"])
    return read.select("stream", F.col("streamSeq").alias("stream_seq"))


@query("wm_late_audit", """, R AS (SELECT 'orders.' || o_orderstatus || '.>' AS "filter", stream_seq, "timestamp",
    max("timestamp") OVER (PARTITION BY o_orderstatus ORDER BY stream_seq) - INTERVAL 30 DAY AS wm FROM O)
  SELECT "filter", stream_seq, epoch_us(wm) // 1000 AS watermark_ms, "timestamp" < wm AS late FROM R""", ("O",))
def wm_late_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The watermark each message meets in its split, and whether it is behind it."""
    chosen = FilterSet.of(spark, [row["filter"] for row in discovery.discover_filters(orders_log(spark, sf), depth=2).collect()])
    read = match_filters(orders_log(spark, sf), chosen, tokens=ORDER_TOKENS, disjoint=True) \
        .select("filter", "stream_seq", M.event_time(F.col("timestamp")).alias("event_time"))
    running = running_max(read, ["filter"], "stream_seq", "event_time", "_top")
    watermark = F.col("_top") - F.expr("INTERVAL 30 DAYS")
    return running.select("filter", "stream_seq", F.unix_millis(watermark).alias("watermark_ms"),
                          (F.col("event_time") < watermark).alias("late"))


@query("filter_skew", """SELECT "filter", count(*) AS n, count(*) / (SELECT count(*) FROM L) AS share FROM
  (SELECT 'events.*.' || user_id AS "filter" FROM L) GROUP BY "filter" """)
def filter_skew(spark: SparkSession, sf: str) -> DataFrame:
    """Share of the log per filter, for one filter per user."""
    source = log(spark, sf)
    per_user = source.select(F.concat(F.lit("events.*."), F.col("user_id").cast("string")).alias("filter")).distinct()
    matched = match_filters(source.select("subject"), FilterSet.of(spark, saved(per_user, "filters")))
    return share(matched, ["filter"])


@query("readme_query", """SELECT stream_seq, CASE WHEN k >= 40 THEN 'high' ELSE lower(event_type) END AS band,
  left(event_type, 2) || '/' || lpad(CAST(k AS VARCHAR), 3, '0') AS code, length(event_type) * 10 + k AS weight,
  CAST(user_id AS VARCHAR) AS who, 2 AS n_keys
  FROM L WHERE event_type IN ('click', 'signup') AND k BETWEEN 20 AND 60 ORDER BY stream_seq LIMIT 25""")
def readme_query(spark: SparkSession, sf: str) -> DataFrame:
    """String, arithmetic, map and array expressions over a decoded view, filtered by subject and limited."""
    source = log(spark, sf).withColumn("data", F.encode(F.to_json(F.struct("event_type", k_of().alias("k"))), "UTF-8"))
    view = f"log_{uuid.uuid4().hex}"
    create_log_view(spark, view, frame=source, format="json", schema="event_type STRING, k INT",
                    metadata=["subject", "headers", "streamSeq"])
    return spark.sql(f"""
        SELECT streamSeq AS stream_seq, CASE WHEN k >= 40 THEN 'high' ELSE lower(event_type) END AS band,
               concat(left(event_type, 2), '/', lpad(CAST(k AS STRING), 3, '0')) AS code,
               char_length(event_type) * 10 + k AS weight, h['who'][0] AS who, size(map_keys(h)) AS n_keys
        FROM (SELECT *, map('who', headers['user'], 'levels', array('low', 'high')) AS h FROM {view})
        WHERE split(subject, '[.]')[1] IN ('click', 'signup') AND k BETWEEN 20 AND 60
        ORDER BY stream_seq LIMIT 25""")
