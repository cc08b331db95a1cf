"""Start and stop positions of a read.

A rule is a tuple: ``("earliest",)``, ``("latest",)``, ``("seq", n)``,
``("time", epoch_ms)`` to start; ``("never",)``, ``("latest",)``, ``("seq", n)``,
``("time", epoch_ms)``, ``("count", n)`` to stop.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msglog.operators.sequence import first_n
from msglog.operators.splits import hinted
from msglog.schema import BLOCK, BLOCK_COLUMN

# A physical column that equals the sequence minus an offset, for tables read as logs.
SeqColumn = tuple[str, int]

START_RULES = ("earliest", "latest", "time", "seq")
STOP_RULES = ("never", "latest", "seq", "time", "count")
_ONE = "_one"


def check_rule(kind: str, rule: tuple) -> tuple:
    allowed = START_RULES if kind == "start" else STOP_RULES
    if not rule or rule[0] not in allowed:
        raise ValueError(f"{kind} rule must be one of {allowed}, got {rule!r}")
    if rule[0] in ("seq", "time") and (len(rule) != 2 or rule[1] is None or rule[1] < 0):
        raise ValueError(f"{kind} rule {rule[0]!r} needs a non-negative value")
    if rule[0] == "count" and (len(rule) != 2 or rule[1] is None or rule[1] < 1):
        raise ValueError("stop rule 'count' needs a value of at least 1")
    return rule


def is_bounded(stop: tuple) -> bool:
    return callable(stop) or check_rule("stop", stop)[0] != "never"


def at_millis(df: DataFrame, column: str, epoch_ms: int) -> Column:
    """An instant as a literal of the column's own timestamp type, so that it pushes down."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        text = (datetime(1970, 1, 1) + timedelta(milliseconds=epoch_ms)).isoformat(sep=" ")
        return F.expr(f"TIMESTAMP_NTZ'{text}'")
    return F.timestamp_millis(F.lit(epoch_ms))


def seq_from(log: DataFrame, first: int, seq: SeqColumn | None = None) -> Column:
    """``stream_seq >= first`` in a form that prunes: on the physical column of a table read as
    a log, and on the block partitions of a stored one."""
    column, offset = seq or ("stream_seq", 0)
    condition = F.col(column) >= first - offset
    return (F.col(BLOCK_COLUMN) >= first // BLOCK) & condition if BLOCK_COLUMN in log.columns else condition


def seq_to(log: DataFrame, last: int, seq: SeqColumn | None = None) -> Column:
    """``stream_seq <= last``, likewise."""
    column, offset = seq or ("stream_seq", 0)
    condition = F.col(column) <= last - offset
    return (F.col(BLOCK_COLUMN) <= last // BLOCK) & condition if BLOCK_COLUMN in log.columns else condition


def last_seq(log: DataFrame) -> int:
    """The last sequence stored now; 0 for an empty log."""
    row = log.agg(F.max("stream_seq").alias("last")).first()
    return row.last or 0


def start_at(log: DataFrame, rule: tuple, snapshot: int | None = None, seq: SeqColumn | None = None) -> DataFrame:
    """Apply a start rule. ``latest`` delivers only what follows the ``snapshot`` sequence;
    without one a batch read starts at its own end and is empty."""
    kind = check_rule("start", rule)[0]
    if kind == "earliest":
        return log
    if kind == "latest":
        return log.where(F.lit(False)) if snapshot is None else log.where(seq_from(log, snapshot + 1, seq))
    if kind == "seq":
        return log.where(seq_from(log, rule[1], seq))
    return log.where(F.col("timestamp") >= at_millis(log, "timestamp", rule[1]))


def stop_cuts(log: DataFrame, rule: tuple, split: str = "split_id", seq: SeqColumn | None = None) -> DataFrame:
    """Per split, the sequence of the first message at or past the stop (the last one read)."""
    reached = (seq_from(log, rule[1], seq) if rule[0] == "seq"
               else F.col("timestamp") >= at_millis(log, "timestamp", rule[1]))
    keys = [split, _ONE] if _ONE in log.columns else [split]
    return log.where(reached).groupBy(*keys).agg(F.min("stream_seq").alias("cut"))


def _one() -> Column:
    """A key that is the same in all rows but no constant to the optimizer: where the split is a literal
    (a table read as one stream, a single filter), the join with the cuts is still an equality."""
    return F.shiftright("stream_seq", 62)


def _with_cut(log: DataFrame, cuts: DataFrame, split: str, n_splits: int | None) -> DataFrame:
    return log.withColumn(_ONE, _one()).join(hinted(cuts, n_splits), [split, _ONE], "left")


def _until(log: DataFrame, cuts: DataFrame, n_splits: int, seq: SeqColumn | None) -> DataFrame:
    """Nothing past the last cut is read, provided that every split has one."""
    column, offset = seq or ("stream_seq", 0)
    never = F.lit((1 << 63) - 1)
    bound = F.when(F.count(F.lit(1)) == n_splits, F.max("cut") - offset).otherwise(never)
    return log.where(F.col(column) <= cuts.agg(bound.alias("bound")).scalar())


def tie_columns(log: DataFrame, split: str | None) -> tuple[str, ...]:
    """What tells rows of one sequence apart: their stream and split, where the log has them."""
    return tuple(c for c in ("stream", split) if c in log.columns)


def stop_at(log: DataFrame, rule: tuple, split: str | None = None, n_splits: int | None = None,
            snapshot: int | None = None, seq: SeqColumn | None = None, one_stream: bool = False) -> DataFrame:
    """Apply a stop rule. ``seq`` and ``time`` stop each split of each stream on its own, after
    its first message at or past the stop; ``count`` counts in the order of sequences, then
    streams and splits, over the whole read. ``one_stream`` states that the log has one stream
    and ``n_splits`` splits; the scan then ends at the last cut. A rule may also be a function
    from the log to the part of it that is read.

    ``latest`` stops at the ``snapshot`` sequence. Without one nothing needs to be cut: a
    batch frame lists its files when it is built, and what is appended later is not in it.
    """
    if callable(rule):
        return rule(log)
    kind = check_rule("stop", rule)[0]
    if kind == "never" or (kind == "latest" and snapshot is None):
        return log
    if kind == "latest":
        return log.where(seq_to(log, snapshot, seq))
    if kind == "count":
        return first_n(log, rule[1], physical=seq, ties=() if one_stream and not split else tie_columns(log, split))
    if split is None and one_stream:
        return _until(log, stop_cuts(log.withColumn("_all", F.lit(0)), rule, "_all", seq), 1, seq)
    cuts = stop_cuts(log.withColumn(_ONE, _one()), rule, split or "stream", seq)
    if one_stream and n_splits is not None:
        log = _until(log, cuts, n_splits, seq)
    return (_with_cut(log, cuts, split or "stream", n_splits if one_stream else None)
            .where(F.col("cut").isNull() | (F.col("stream_seq") <= F.col("cut")))
            .select(*log.columns))


def finished(log: DataFrame, rule: tuple, split: str = "split_id", n_splits: int | None = None,
             seq: SeqColumn | None = None) -> DataFrame:
    """Per split: messages read, last sequence read, and whether the stop was reached."""
    cuts = stop_cuts(log.withColumn(_ONE, _one()), rule, split, seq)
    kept = _with_cut(log, cuts, split, n_splits).where(F.col("cut").isNull() | (F.col("stream_seq") <= F.col("cut")))
    return kept.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_read"),
        F.max("stream_seq").alias("last_read"),
        F.max(F.col("cut").isNotNull()).alias("finished"),
    )
