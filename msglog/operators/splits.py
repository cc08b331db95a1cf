"""Subject filters as splits: matching a log against many filters at once.

``FilterSet`` is the set of filters of one read. A handful of filters given as a
list is matched with plain predicates; anything larger becomes an equality join
on the candidate filter of each shape. Neither compares every message with every
filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msglog.functions import subjects as S
from msglog.operators.components import components
from msglog.sources.store import saved

# Lists up to this length are matched by predicates, without a join.
INLINE_FILTERS = 16
# Longer lists become a table of their own instead of literals in the plan.
LITERAL_ROWS = 500
# Filter tables up to this many rows are broadcast; larger ones shuffle.
BROADCAST_ROWS = 100_000


def values(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """A small literal table that stays inside the JVM."""
    structs = [F.struct(*[F.lit(v).alias(k) for k, v in row.items()]) for row in rows]
    return spark.sql("SELECT inline(:rows)", args={"rows": F.array(*structs)})


def hinted(df: DataFrame, rows: int | None) -> DataFrame:
    """Broadcast ``df`` when it is known to hold few rows; otherwise leave it to AQE."""
    return F.broadcast(df) if rows is not None and rows <= BROADCAST_ROWS else df


@dataclass(frozen=True)
class FilterSet:
    """Filters with payload columns, their distinct shapes and their number."""

    frame: DataFrame
    shapes: tuple[str, ...]
    size: int
    inline: tuple[str, ...] = ()

    @classmethod
    def of(cls, spark: SparkSession, filters: Sequence[str] | DataFrame) -> FilterSet:
        if isinstance(filters, DataFrame):
            return cls._of_table(filters)
        filters = tuple(dict.fromkeys(filters))
        if not filters:
            raise ValueError("at least one subject filter is needed")
        shapes = tuple(sorted({S.shape_of(f) for f in filters}))
        frame = (values(spark, [{"filter": f} for f in filters]) if len(filters) <= LITERAL_ROWS
                 else spark.createDataFrame([(f,) for f in filters], "filter STRING"))
        return cls(frame, shapes, len(filters), filters if len(filters) <= INLINE_FILTERS else ())

    @classmethod
    def _of_table(cls, filters: DataFrame) -> FilterSet:
        filters = filters.distinct()
        # One row per shape: its number depends on the depth of the subjects, not on the filters.
        found = (filters.groupBy(S.shape(F.col("filter")).alias("shape"))
                 .agg(F.count(F.lit(1)).alias("n"),
                      F.min(F.when(~S.is_valid_filter(F.col("filter")), F.col("filter"))).alias("bad"))
                 .collect())
        bad = [row.bad for row in found if row.bad is not None]
        if bad:
            raise ValueError(f"invalid subject filter {bad[0]!r}")
        return cls(filters, tuple(sorted(row["shape"] for row in found)), sum(row.n for row in found))


def match_filters(log: DataFrame, filters: FilterSet, subject: str = "subject",
                  tokens: S.TokenColumns | None = None, disjoint: bool = False) -> DataFrame:
    """``log`` with a ``filter`` column: one row per message and filter it matches.

    ``disjoint`` states that no message matches two of the filters, as is checked for every
    read with explicit filters; a short list then needs no row generation.
    """
    if not filters.inline:
        return _match_join(log, filters, subject)
    names = {f: F.lit(f) for f in filters.inline}
    return _match_inline(log, names, "filter", subject, tokens, disjoint)


def match_splits(log: DataFrame, filters: FilterSet, prefix: str, subject: str = "subject",
                 tokens: S.TokenColumns | None = None, disjoint: bool = False) -> DataFrame:
    """:func:`match_filters` with the ``consumer`` and ``split_id`` of each filter, named once
    per filter and not once per message."""
    if filters.inline:
        names = {f: F.struct(F.lit(f).alias("filter"), S.consumer_name(prefix, F.lit(f)).alias("consumer"))
                 for f in filters.inline}
        matched = _match_inline(log, names, "_split", subject, tokens, disjoint)
        matched = matched.select(*log.columns, "_split.filter", "_split.consumer")
    else:
        named = replace(filters, frame=filters.frame.withColumn("consumer", S.consumer_name(prefix, F.col("filter"))))
        matched = _match_join(log, named, subject)
    return matched.withColumn("split_id", S.split_id(F.col("stream"), F.col("consumer")))


def _match_inline(log: DataFrame, names: dict[str, Column], out: str, subject: str,
                  tokens: S.TokenColumns | None, disjoint: bool) -> DataFrame:
    if len(names) == 1:
        [(filter_, value)] = names.items()
        return log.where(S.matches(filter_, subject, tokens)).withColumn(out, value)
    kept = log.where(S.guard_any(names, subject, tokens))
    hits = [F.when(S.matches(f, subject), value) for f, value in names.items()]
    found = F.coalesce(*hits) if disjoint else F.explode(F.array(*hits))
    return kept.withColumn(out, found).where(F.col(out).isNotNull())


def _match_join(log: DataFrame, filters: FilterSet, subject: str) -> DataFrame:
    """Filters with a ``stream`` see that stream only. No filters deliver nothing."""
    on = ["_key", "stream"] if "stream" in filters.frame.columns else ["_key"]
    payload = [f for f in filters.frame.schema.fields if f.name not in on]
    if not filters.shapes:
        return log.where(F.lit(False)).withColumns({f.name: F.lit(None).cast(f.dataType) for f in payload})
    keys = F.array(*[_key(F.lit(s), S.candidate(s, F.col("_words"))) for s in filters.shapes])
    keyed = (log.withColumn("_words", F.split(F.col(subject), r"\."))
             .where(~F.array_contains("_words", ""))
             .withColumn("_key", F.explode(keys))
             .where(F.col("_key").isNotNull())
             .drop("_words"))
    table = filters.frame.withColumn("_key", _key(S.shape(F.col("filter")), F.col("filter")))
    return keyed.join(hinted(table, filters.size), on).select(*log.columns, *[f.name for f in payload])


def _key(shape: Column, filter_: Column) -> Column:
    # The shape keeps a token that merely looks like a wildcard from posing as one.
    return F.concat(shape, F.lit(":"), filter_)


def with_split(filters: DataFrame, prefix: str) -> DataFrame:
    """``(stream, filter)`` rows with their ``consumer`` and ``split_id``."""
    named = filters.withColumn("consumer", S.consumer_name(prefix, F.col("filter")))
    return named.withColumn("split_id", S.split_id(F.col("stream"), F.col("consumer")))


def multi_match(matched: DataFrame, by: Sequence[str] = ("stream", "stream_seq")) -> DataFrame:
    """Messages that more than one filter of the read would deliver."""
    return (matched.groupBy(*by).agg(F.count(F.lit(1)).alias("n_filters"))
            .where(F.col("n_filters") > 1))


def first_capture(log: DataFrame, filters: FilterSet, payload: str, subject: str = "subject") -> DataFrame:
    """``log`` with the ``payload`` of the filter that captures each message, or NULL.

    One left join per shape, each on equality; a message keeps exactly one row. Of
    several capturing filters the first in shape order decides.
    """
    out = log.withColumn("_words", F.split(F.col(subject), r"\."))
    found = []
    for i, s in enumerate(filters.shapes):
        table = (filters.frame.where(S.shape(F.col("filter")) == s)
                 .groupBy("filter").agg(F.min(payload).alias(f"_p{i}"))
                 .withColumnRenamed("filter", f"_f{i}"))
        out = out.join(hinted(table, filters.size), S.candidate(s, F.col("_words")) == F.col(f"_f{i}"), "left")
        found.append(F.col(f"_p{i}"))
    hit = F.coalesce(*found) if found else F.lit(None).cast("string")
    extra = [c for i in range(len(found)) for c in (f"_p{i}", f"_f{i}")]
    return out.withColumn(payload, hit).drop("_words", *extra)


def _overlap_keys(filters: FilterSet) -> DataFrame:
    """``(filter, stream, key, first)``: two filters overlap exactly when they share a key, one
    as ``first`` and one not. ``stream`` is empty for filters that hold for all streams.

    For two shapes, filters meet when their words agree wherever both shapes have a literal, so
    each pair of shapes is one equality.
    """
    stream = F.coalesce("stream", F.lit("")) if "stream" in filters.frame.columns else F.lit("")
    words = filters.frame.select("filter", stream.alias("stream")).distinct() \
        .withColumn("_s", S.shape(F.col("filter"))).withColumn("_w", F.split(F.col("filter"), r"\."))
    pairs = [(x, y) for i, x in enumerate(filters.shapes) for y in filters.shapes[i:] if _compatible(x, y)]
    keys = []
    for n, pair in enumerate(pairs):
        shared = [i for i, (p, q) in enumerate(zip(*pair)) if p == q == "L"]
        key = F.concat_ws(".", F.lit(str(n)), *[F.get(F.col("_w"), F.lit(i)) for i in shared])
        keys += [F.when(F.col("_s") == shape_, F.struct(key.alias("key"), F.lit(first).alias("first")))
                 for shape_, first in zip(pair, (True, False))]
    keyed = words.select("filter", "stream", F.explode(F.array(*keys) if keys else F.array().cast(
        "array<struct<key:string,first:boolean>>")).alias("_k"))
    return keyed.where(F.col("_k").isNotNull()).select("filter", "stream", "_k.key", "_k.first")


def overlapping(filters: FilterSet) -> DataFrame:
    """Pairs of filters that some subject could match both, ``a`` before ``b``: real overlaps only."""
    keyed = _overlap_keys(filters)
    one = keyed.where("first").select(F.col("filter").alias("x"), "stream", "key")
    two = keyed.where("not first").select(F.col("filter").alias("y"), "stream", "key")
    joined = one.join(two, ["stream", "key"]).where(F.col("x") != F.col("y"))
    return joined.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def overlap_classes(filters: FilterSet) -> DataFrame:
    """``(stream, filter, class, n_overlaps)`` of every filter: the first filter of those that chains of overlaps
    join it with, and the number of filters it overlaps. All filters of one side of a key overlap all of the
    other, so both come from a row for each key; pairs are never listed."""
    keyed = _overlap_keys(filters)
    sides = keyed.groupBy("stream", "key").agg(
        F.sum(F.col("first").cast("int")).alias("_one"), F.sum((~F.col("first")).cast("int")).alias("_two"),
        F.min(F.xxhash64("stream", "filter")).alias("root")).where((F.col("_one") > 0) & (F.col("_two") > 0))
    met = saved(keyed.join(sides, ["stream", "key"]).select(
        "stream", "filter", F.xxhash64("stream", "filter").alias("node"), "root",
        F.when(F.col("first"), F.col("_two")).otherwise(F.col("_one")).alias("n")), "met")
    # The key of a filter's own shape has the filter itself on both sides, and no other.
    counts = met.groupBy("stream", "filter", "node").agg((F.sum("n") - 2).alias("n_overlaps"))
    roots = components(met.select("node", "root"))
    named = counts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = named.groupBy("root").agg(F.min("filter").alias("class"))
    return named.join(first, "root").select("stream", "filter", "class", "n_overlaps")


def overlaps_of(filters: FilterSet, filter_: str) -> DataFrame:
    """The filters that overlap one of them, on request: only its own keys are looked up."""
    keyed = _overlap_keys(filters)
    own = keyed.where(F.col("filter") == filter_).select("stream", "key", F.col("first").alias("_own"))
    found = keyed.join(own, ["stream", "key"]).where((F.col("first") != F.col("_own")) & (F.col("filter") != filter_))
    return found.select("stream", "filter").distinct()


def overlap_witnesses(filters: FilterSet) -> DataFrame:
    """One overlapping pair ``(a, b)`` for each key that has any: an aggregate, so the pairs of a
    common key are never listed."""
    one, two = F.when(F.col("first"), F.col("filter")), F.when(~F.col("first"), F.col("filter"))
    ends = _overlap_keys(filters).groupBy("stream", "key").agg(
        F.min(one).alias("a"), F.max(one).alias("c"), F.min(two).alias("b"), F.max(two).alias("d"))
    pair = F.when(F.col("a") != F.col("b"), F.struct("a", "b")) \
        .when(F.col("a") != F.col("d"), F.struct("a", F.col("d").alias("b"))) \
        .when(F.col("c") != F.col("b"), F.struct(F.col("c").alias("a"), "b"))
    return ends.where(pair.isNotNull()).select(pair.alias("_p")).select(
        F.least("_p.a", "_p.b").alias("a"), F.greatest("_p.a", "_p.b").alias("b")).distinct()


def _compatible(x: str, y: str) -> bool:
    """Whether two shapes can match subjects of the same length."""
    if x.endswith(">") and y.endswith(">"):
        return True
    if x.endswith(">"):
        return len(y) >= len(x)
    if y.endswith(">"):
        return len(x) >= len(y)
    return len(x) == len(y)


def check_no_overlap(spark: SparkSession, filters: Sequence[str] | DataFrame) -> None:
    """Raise ValueError when two filters of one read overlap."""
    chosen = FilterSet.of(spark, filters)
    if chosen.inline:
        clash = [pair for pair in combinations(chosen.inline, 2) if S.collide(*pair)]
    else:
        clash = [(row.a, row.b) for row in overlap_witnesses(chosen).limit(5).collect()]
    if clash:
        shown = ", ".join(f"{a} / {b}" for a, b in clash[:5])
        raise ValueError(f"overlapping subject filters in one read: {shown}")


def share(frame: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per group and their share of all rows."""
    counts = frame.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    # The total comes from the counts, which share their exchange with this one.
    total = counts.agg(F.sum("n").alias("total"))
    return counts.withColumn("share", F.col("n") / total.scalar())


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
