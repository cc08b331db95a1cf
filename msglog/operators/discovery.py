"""Discovery of subject filters as table operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msglog.operators.splits import FilterSet, match_filters


def discover_filters(log: DataFrame, depth: int) -> DataFrame:
    """``(stream, filter)`` covering a log: the first ``depth`` tokens of its subjects and a
    tail wildcard, or the subject itself where it is no longer than that."""
    words = F.split(F.col("subject"), r"\.")
    prefix = F.array_join(F.slice(words, 1, depth), ".")
    filter_ = F.when(F.size(words) > depth, F.concat(prefix, F.lit(".>"))).otherwise(F.col("subject"))
    return log.select("stream", filter_.alias("filter")).distinct()


def added(old: DataFrame, new: DataFrame, keys: Sequence[str] = ("stream", "filter")) -> DataFrame:
    """Filters of the new snapshot that the old one did not have."""
    return new.join(old, list(keys), "left_anti")


def revoked(old: DataFrame, new: DataFrame, keys: Sequence[str] = ("stream", "filter")) -> DataFrame:
    """Filters of the old snapshot that the new one no longer has."""
    return old.join(new, list(keys), "left_anti")


def update_registry(registry: DataFrame, current: DataFrame, seq: int) -> DataFrame:
    """Bring ``registry(stream, filter, from_seq, to_seq)`` to the ``current`` filters.

    New filters take effect at ``seq``; open entries that vanished end there; the history
    stays. ``to_seq`` is exclusive and NULL while a filter is in force.
    """
    keys = ["stream", "filter"]
    live = registry.where(F.col("to_seq").isNull())
    now = current.select(*keys).distinct().withColumn("_now", F.lit(True))
    closed = (registry.join(now, keys, "left")
              .withColumn("to_seq", F.when(F.col("to_seq").isNull() & F.col("_now").isNull(), F.lit(seq))
                          .otherwise(F.col("to_seq")).cast("long"))
              .select("stream", "filter", "from_seq", "to_seq"))
    opened = added(live, now.drop("_now")).select(
        "stream", "filter", F.lit(seq).cast("long").alias("from_seq"), F.lit(None).cast("long").alias("to_seq"))
    return closed.unionByName(opened)


def scan_history(spark: SparkSession, log: DataFrame, registry: DataFrame) -> DataFrame:
    """Messages read under a filter history: a filter sees only what was stored while it was
    in force, so a revoked one delivers nothing more and a new one nothing older."""
    history = registry.select(*[c for c in ("stream", "filter", "from_seq", "to_seq") if c in registry.columns])
    return in_force(match_filters(log, FilterSet.of(spark, history)), keep=True)


def in_force(matched: DataFrame, keep: bool = False) -> DataFrame:
    """Matched messages whose filter was in force when they were stored, where the filters say so;
    ``keep`` keeps the interval columns."""
    if "from_seq" in matched.columns:
        matched = matched.where(F.col("from_seq").isNull() | (F.col("stream_seq") >= F.col("from_seq")))
    if "to_seq" in matched.columns:
        matched = matched.where(F.col("to_seq").isNull() | (F.col("stream_seq") < F.col("to_seq")))
    return matched if keep else matched.drop("from_seq", "to_seq")


def unread(filters: DataFrame, progress: DataFrame) -> DataFrame:
    """Splits that have no progress yet."""
    return filters.join(progress.select("split_id"), "split_id", "left_anti")
