"""Dense positions and running values over a totally ordered log.

A window over a whole log, or over one hot split, would run in a single task.
These operators cut the order into buckets of at most ``width`` consecutive
sequence numbers, aggregate per bucket, carry the small per-bucket results
forward, and rank only inside a bucket. Sequence numbers are unique in a stream,
so no bucket exceeds ``width`` rows per key whatever the skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_WIDTH = 1 << 20
# Limits up to this many rows use a top-k; larger ones look for the cut sequence.
TOP_K_ROWS = 100_000
# Bitmaps of marked rows hold this many bits of the order.
SPAN_BITS = 15
# Spans that may be sent to all tasks: 4 KB each at most.
MAX_SPANS = 16_384


def _bucket(order: str, width: int) -> Column:
    return F.expr(f"`{order}` div {int(width)}")


def _before(keys: Sequence[str]):
    return (Window.partitionBy(*keys).orderBy("_bucket")
            .rowsBetween(Window.unboundedPreceding, -1))


def dense_seq(df: DataFrame, keys: Sequence[str], order: str, out: str,
              pending: str | None = None, width: int = BUCKET_WIDTH) -> DataFrame:
    """Number the rows of each key 1, 2, … by ``order``, an integer unique within the key.

    ``pending`` names a second column holding how many rows of the key come after.
    """
    return number_buckets(df.withColumn("_bucket", _bucket(order, width)), keys, order, out, pending) \
        .drop("_bucket")


def bucket_offsets(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key and ``_bucket``: the rows of the key before the bucket and in all."""
    counts = df.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    return counts.select(
        *keys, "_bucket",
        F.coalesce(F.sum("_rows").over(_before(keys)), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(Window.partitionBy(*keys)).alias("_total"),
    )


def number_buckets(df: DataFrame, keys: Sequence[str], order: str, out: str,
                   pending: str | None = None) -> DataFrame:
    """:func:`dense_seq` for rows that already carry a ``_bucket`` ascending with ``order``."""
    keys = list(keys)
    rank = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(order))
    numbered = (df.withColumn("_rank", rank)
                .join(bucket_offsets(df, keys), [*keys, "_bucket"])
                .withColumn(out, (F.col("_offset") + F.col("_rank")).cast("long")))
    columns = [*df.columns, out]
    if pending:
        numbered = numbered.withColumn(pending, (F.col("_total") - F.col(out)).cast("long"))
        columns.append(pending)
    return numbered.select(*columns)


def marked_spans(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """``(keys, _span, _n, _bits, _offset, _total)``: which rows of a key there are, a bitmap for every span of
    32,768 values of ``order``, NULL where they are the first ones of the span without a gap; how many come
    before the span; how many there are in all. Only keys and order are read and moved."""
    place = F.col(order).bitwiseAND(F.lit((1 << SPAN_BITS) - 1))
    spans = (rows.select(*keys, F.shiftright(order, SPAN_BITS).alias("_span"), place.alias("_place"))
             .groupBy(*keys, "_span").agg(F.count(F.lit(1)).alias("_n"), F.max("_place").alias("_top"),
                                          F.bitmap_construct_agg("_place").alias("_bits")))
    before = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    return spans.select(*keys, "_span", "_n", F.when(F.col("_n") <= F.col("_top"), F.col("_bits")).alias("_bits"),
                        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
                        F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"))


def in_span(order: str) -> tuple[Column, Column]:
    """For a row joined with its span: whether it is marked, and how many marked rows of the span come before."""
    place = f"(`{order}` & {(1 << SPAN_BITS) - 1})"
    byte = f"CAST(conv(hex(substring(_bits, CAST({place} div 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    marked = F.expr(f"CASE WHEN _bits IS NULL THEN {place} < _n ELSE getbit({byte}, CAST({place} % 8 AS INT)) = 1 END")
    before = F.expr(f"CASE WHEN _bits IS NULL THEN {place} ELSE bitmap_count(substring(_bits, 1, CAST({place} div 8 AS INT))) "
                    f"+ bit_count({byte} & (shiftleft(1, CAST({place} % 8 AS INT)) - 1)) END")
    return marked, before


def positions(df: DataFrame, keys: Sequence[str], order: str, out: str, pending: str | None = None,
              n_spans: int | None = None) -> DataFrame:
    """:func:`dense_seq` without moving rows: only keys and order are aggregated, into bitmaps, which go to the
    tasks that read the rows. ``n_spans`` bounds the spans of all keys; where it is unknown or too large to
    send, rows are numbered by bucket."""
    if n_spans is None or n_spans > MAX_SPANS:
        return dense_seq(df, keys, order, out, pending)
    spans = marked_spans(df, keys, order)
    _, before = in_span(order)
    # The span is a key that no optimizer takes for a constant, so the join is an equality for literal keys too.
    found = df.withColumn("_span", F.shiftright(order, SPAN_BITS)).join(F.broadcast(spans), [*keys, "_span"])
    found = found.withColumn(out, (F.col("_offset") + before + 1).cast("long"))
    columns = [*df.columns, out]
    if pending:
        found = found.withColumn(pending, (F.col("_total") - F.col(out)).cast("long"))
        columns.append(pending)
    return found.select(*columns)


def running_max(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str,
                width: int = BUCKET_WIDTH) -> DataFrame:
    """The largest ``value`` of the key up to and including each row, by ``order``."""
    keys = list(keys)
    bucketed = df.withColumn("_bucket", _bucket(order, width))
    tops = bucketed.groupBy(*keys, "_bucket").agg(F.max(value).alias("_top"))
    carried = tops.select(*keys, "_bucket", F.max("_top").over(_before(keys)).alias("_carry"))
    inside = F.max(value).over(Window.partitionBy(*keys, "_bucket").orderBy(order)
                               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (bucketed.withColumn("_inside", inside)
            .join(carried, [*keys, "_bucket"])
            .withColumn(out, F.greatest("_carry", "_inside"))
            .select(*df.columns, out))


def nth_seq(df: DataFrame, n: int, order: str = "stream_seq", width: int = BUCKET_WIDTH,
            ties: Sequence[str] = ()) -> DataFrame:
    """One row, column ``cut``: the ``n``-th smallest ``order``, or NULL if there are fewer. With
    ``ties``, which tell rows of one ``order`` apart, also column ``place``: all of that row's."""
    keyed = df.select(order, *ties).withColumn("_bucket", _bucket(order, width))
    counts = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(_before([])), F.lit(0))
    target = (counts.withColumn("_before", before)
              .where((F.col("_before") < n) & (F.col("_before") + F.col("_n") >= n)))
    # One bucket is left: at most `width` rows of each stream are ranked.
    inside = keyed.where(F.col("_bucket") == target.select("_bucket").scalar())
    ranked = inside.withColumn("_rank", F.row_number().over(Window.partitionBy("_bucket").orderBy(order, *ties)))
    wanted = F.lit(n) - target.select("_before").scalar()
    return ranked.where(F.col("_rank") == wanted).agg(
        F.max(order).alias("cut"), *([F.max(F.struct(order, *ties)).alias("place")] if ties else []))


def first_n(df: DataFrame, n: int, order: str = "stream_seq", physical: tuple[str, int] | None = None,
            ties: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows by ``order``, an integer; ``ties`` are columns that tell rows of one
    ``order`` apart and decide between them, for reads over several streams or splits.

    The cut is looked for in these columns alone; the second pass takes it to the scan, so other
    columns are read around the first rows only, and the result stays distributed. ``physical`` is
    a column that equals ``order`` minus an offset, where the scan has one.
    """
    if n < 1:
        raise ValueError("a message limit must be at least 1")
    if n <= TOP_K_ROWS:
        head = df.select(order, *ties).orderBy(order, *ties).limit(n)
        full = F.count(F.lit(1)) == n
        cut = head.agg(F.when(full, F.max(order)).alias("cut"),
                       *([F.when(full, F.max(F.struct(order, *ties))).alias("place")] if ties else []))
    else:
        cut = nth_seq(df, n, order, ties=ties)
    column, offset = physical or (order, 0)
    everything = F.lit((1 << 63) - 1)
    bound = cut.select(F.coalesce(F.col("cut") - offset, everything).alias("bound"))
    kept = df.where(F.col(column) <= bound.scalar())
    if not ties:
        return kept
    place = cut.select("place").scalar()
    return kept.where(place.isNull() | (F.struct(order, *ties) <= place))
