"""Registry of runnable queries, each next to the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
# What the query that is being built has looked up; each query looks again.
FOUND: dict = {}

# The logs of msglog.sources.adapters, as SQL over the source tables.
_L = """L AS (SELECT 'events' AS stream, 'events.' || event_type || '.' || user_id AS subject,
  event_id + 1 AS stream_seq, ts AS "timestamp", event_id, user_id, event_type, value, props,
  CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)"""
_O = """O AS (SELECT 'orders' AS stream, 'orders.' || o_orderstatus || '.' || substr(o_orderpriority, 1, 1) AS subject,
  o_orderkey + 1 AS stream_seq, o_orderdate AS "timestamp", * FROM orders)"""
_D = """D AS (SELECT 'docs' AS stream, 'docs.' || lang || '.' || source AS subject,
  doc_id + 1 AS stream_seq, text FROM documents)"""
# The log read through one split per event type, and the tables derived from that read.
_S = """S AS (SELECT L.*, 'events.' || event_type || '.>' AS "filter",
  'consumer-' || substr(md5('events.' || event_type || '.>'), 1, 5) AS consumer,
  'events > consumer-' || substr(md5('events.' || event_type || '.>'), 1, 5) AS split_id FROM L)"""
_DELIVERIES = """deliveries AS (
  SELECT split_id, stream_seq, 1 AS attempt, "timestamp" AS delivered_at FROM S
  UNION ALL
  SELECT split_id, stream_seq, 2, "timestamp" + INTERVAL 30 SECOND FROM S WHERE k >= 80)"""
_ACKS = """acks AS (SELECT split_id, stream_seq FROM S
  WHERE "timestamp" < TIMESTAMP '2024-01-05' OR ("timestamp" < TIMESTAMP '2024-01-20' AND k <> 13))"""
_PROGRESS = """progress AS (
  SELECT split_id, max(stream_seq) FILTER ("timestamp" < TIMESTAMP '2024-01-12') AS last_seq,
    CASE WHEN event_type = 'view' THEN 'paused' ELSE 'active' END AS status
  FROM S WHERE event_type <> 'signup' GROUP BY split_id, event_type)"""

_PARTS = {"L": _L, "O": _O, "D": _D, "S": _S, "deliveries": _DELIVERIES, "acks": _ACKS, "progress": _PROGRESS}


def with_logs(sql: str, *parts: str) -> str:
    """Prefix a statement with the common table expressions it uses."""
    return "WITH " + ",\n".join(_PARTS[p] for p in parts) + "\n" + sql.strip()


def query(name: str, sql: str | None = None, uses: tuple[str, ...] = ("L",)) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may start with further CTEs, introduced by a comma."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            FOUND.clear()
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_logs(sql, *uses) if uses else sql.strip()
        return fn

    return register
