"""Merkle fingerprints of documents: a tree over sections, paragraphs and short runs of words.

A text's sections lie between blank lines (``\\n\\n``), a section's paragraphs between line ends, and a
paragraph is cut into runs of up to four words of one sentence with the white space behind them. A run's
node is a digest of its text, a paragraph's the SHA-256 of its runs' nodes, a section's that of its
paragraphs' nodes, the root that of the sections' nodes; the root is the fingerprint. Cutting loses
nothing, so equal roots mean equal texts. Two trees are compared from the root down: children are
matched by their nodes, wherever they stand, and only sections without a match are entered
(:func:`differing`), so a line put in front differs in one place. The share of runs that two trees have
in common, read off their lowest nodes, is their likeness.

Everything is DataFrame functions. Scale: neighbours in the order of ids are found in one shuffle.
Ids are cut into ranges at quantiles, a window within a range looks one row ahead, and the last row
of a range gets the first row of the next, of which there is one per range. Rows of an id that fills
several ranges are dealt over them by the hash of their text, and so are rows with NULL ids, which have
ranges of their own. Rows that are equal in both stay together.

Defined cases: NULL texts count as empty; an empty text has one empty paragraph and no runs; two
texts without runs have likeness 1; NULL ids come last; rows with one id are ordered by the hash
of their text; a single row is its own neighbour; texts of any length are read whole; columns but the
id and the text are not looked at, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msglog.llm.common import partitions

# Up to four words of a line and the white space behind them; a word that ends a sentence ends the run.
RUN = r"(?:[^ \t\x0B\f\r]*[^ \t\x0B\f\r.!?][ \t\x0B\f\r]+){0,3}[^ \t\x0B\f\r]+[ \t\x0B\f\r]*|[ \t\x0B\f\r]+"
RANGES_PER_PARTITION = 4


def tree(text: Column) -> Column:
    """The sections of a text: array of (digest, paragraphs array of (digest, runs array of digests))."""
    def paragraph(part: Column) -> Column:
        runs = F.transform(F.regexp_extract_all(part, F.lit(RUN), F.lit(0)), lambda w: F.substring(F.sha2(w, 256), 1, 32))
        return F.struct(F.sha2(F.concat(F.lit("p"), F.array_join(runs, "")), 256).alias("digest"), runs.alias("runs"))

    def section(part: Column) -> Column:
        nodes = F.transform(F.split(part, "\n"), paragraph)
        return F.struct(F.sha2(F.concat(F.lit("s"), F.array_join(F.transform(nodes, lambda p: p["digest"]), "")), 256).alias("digest"),
                        nodes.alias("paragraphs"))

    return F.transform(F.split(text, "\n\n"), section)


def root(sections: Column) -> Column:
    """The root of a tree: the document's fingerprint."""
    digests = F.transform(sections, lambda s: s["digest"])
    return F.sha2(F.concat(F.lit("r"), F.array_join(digests, "")), 256)


def differing(a: Column, b: Column) -> Column:
    """Places (section, paragraph), from 0, of tree ``a`` that tree ``b`` has nothing equal to: sections that
    ``b`` has anywhere are not entered, and the paragraphs of others are looked for in the sections of ``b``
    that ``a`` does not have. The other way round gives what ``b`` has and ``a`` has not."""
    def matched(nodes: Column) -> Column:
        # The paragraphs of the other tree's sections that are not matched as a whole.
        rest = F.flatten(F.transform(F.filter(b, lambda s: ~F.array_contains(nodes["own"], s["digest"])),
                                     lambda s: F.transform(s["paragraphs"], lambda p: p["digest"])))
        return _with(rest, lambda known: F.flatten(F.transform(a, lambda s, i: within(s, i, nodes, known))))

    def within(s: Column, i: Column, nodes: Column, known: Column) -> Column:
        places = F.filter(F.transform(s["paragraphs"], lambda p, j: F.when(~F.array_contains(known, p["digest"]), j)), lambda j: j.isNotNull())
        return F.when(F.array_contains(nodes["other"], s["digest"]), F.array().cast("array<struct<section:int,paragraph:int>>")).otherwise(
            F.transform(places, lambda j: F.struct(i.alias("section"), j.alias("paragraph"))))

    digests = [F.transform(t, lambda s: s["digest"]) for t in (a, b)]
    return _with(F.struct(digests[0].alias("own"), digests[1].alias("other")), matched)


def _with(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def runs(sections: Column) -> Column:
    """The distinct lowest nodes of a tree."""
    return F.array_distinct(F.flatten(F.flatten(F.transform(sections, lambda s: F.transform(s["paragraphs"], lambda p: p["runs"])))))


def likeness(a: Column, b: Column) -> Column:
    """Common lowest nodes over all of two trees, 0 to 1; arguments as :func:`runs` gives them."""
    common = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - common
    return F.when(every == 0, F.lit(1.0)).otherwise(common / every)


def _range_of(key: Column, bounds: list[int], tie: Column) -> Column:
    """The number of the range of a key: how many bounds lie below it; a key that equals several
    bounds is dealt over the ranges between them. Bounds are looked up in two steps."""
    if not bounds:
        return F.lit(0)
    width = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    heads = F.array(*(F.lit(g[0]) for g in groups))
    bodies = F.array(*(F.array(*(F.lit(x) for x in g)) for g in groups))

    def below(test) -> Column:
        whole = F.size(F.filter(heads, lambda x: test(x, key)))
        part = F.get(bodies, F.greatest(whole, F.lit(1)) - 1)
        return F.when(whole == 0, F.lit(0)).otherwise((whole - 1) * width + F.size(F.filter(part, lambda x: test(x, key))))

    low, high = below(lambda x, k: x < k), below(lambda x, k: x <= k)
    return low + F.pmod(tie, high - low + 1)


def with_next(docs: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """``docs(doc_id, text)`` with the text of the next row in descending doc_id (after the last, the
    first) as ``next_text``. ``extra`` columns are computed from ``text`` on the way and come for
    both rows, as ``name`` and ``next_name``."""
    extra = extra or {}
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    count = RANGES_PER_PARTITION * partitions(docs)
    at = [i / count for i in range(1, count)]
    bounds = rows.agg(F.percentile_approx("doc_id", at, 10 * count)).first()[0] or []
    hashed = F.xxhash64("text")
    # Rows without an id come after all others, in the order of their hash: ranges below zero.
    bits = max(1, (count - 1).bit_length())
    nameless = F.shiftright("tie", 64 - bits) - (1 << (bits - 1)) - 1
    ranged = rows.withColumn("tie", hashed).withColumn("range", F.when(F.col("doc_id").isNull(), nameless).otherwise(
        _range_of(F.col("doc_id"), sorted(bounds), F.col("tie")).cast("long")))

    def whole(frame: DataFrame) -> DataFrame:
        return frame.withColumns(extra) if extra else frame

    # The first row of each range, by its key; there are as many as ranges.
    firsts = ranged.groupBy("range").agg(F.max(F.struct("doc_id", "tie")).alias("first"))
    all_ranges = Window.orderBy(F.desc("range"))  # one row per range
    last_to_first = F.first("range").over(all_ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.select("first", F.col("range").alias("own"),
                           F.coalesce(F.lead("range").over(all_ranges), last_to_first).alias("after"))
    follow = firsts.select(F.col("own").alias("range"), "after")
    keys = firsts.select(F.col("own").alias("after"), "first")
    wanted = follow.join(keys, "after").select(F.col("range").alias("before"), F.col("after").alias("range"),
                                               F.col("first.doc_id").alias("key"), F.col("first.tie").alias("tie"))
    edge = (ranged.join(F.broadcast(wanted), ["range", "tie"]).where(F.col("doc_id").eqNullSafe(F.col("key")))
            .groupBy("before").agg(F.first("text").alias("text")))
    edge = whole(edge).select(F.col("before").alias("range"), F.struct("text", *extra).alias("edge"))

    order = Window.partitionBy("range").orderBy(F.desc_nulls_last("doc_id"), F.desc("tie"))
    own = whole(ranged.repartition("range")).withColumn("ahead", F.lead(F.struct("text", *extra)).over(order))
    ahead = F.coalesce("ahead", "edge")
    return own.join(edge, "range", "left").select(
        "doc_id", "text", *extra, ahead["text"].alias("next_text"), *(ahead[n].alias(f"next_{n}") for n in extra))


def edited_copies(docs: DataFrame) -> DataFrame:
    """Every text, the text with its last third replaced by the start of the next document, the
    fingerprints of both, and their likenesses."""
    rows = with_next(docs, {"tree": tree(F.col("text"))})
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    rows = rows.select(
        "doc_id", n.cast("long").alias("n_chars"), "tree", "next_tree",
        F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third)).alias("edited"))
    rows = rows.withColumn("edited_tree", tree(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), root(F.col("tree")).alias("fingerprint"),
        root(F.col("edited_tree")).alias("edited_fingerprint"),
        likeness(runs(F.col("tree")), runs(F.col("edited_tree"))).alias("near_edited"),
        likeness(runs(F.col("tree")), runs(F.col("next_tree"))).alias("near_next"),
        F.size(differing(F.col("edited_tree"), F.col("tree"))).alias("edited_paragraphs"))


_WS = r" \t\x0B\f\r"
_SQL_RUNS = (r"list_transform(regexp_extract_all({0}, '(?:[^WS]*[^WS.!?][WS]+){{0,3}}[^WS]+[WS]*|[WS]+'), "
             r"lambda w: substr(sha256(w), 1, 32))").replace("WS", _WS)
# Sections as lists of paragraphs as (digest, runs).
_SQL_TREE = ("list_transform(string_split({0}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)), "
             "lambda p: {{'runs': " + _SQL_RUNS.format("p").replace("{0,3}", "{{0,3}}") + "}}))")
_SQL_NODES = "list_transform({0}, lambda s: list_transform(s, lambda p: sha256('p' || array_to_string(p.runs, ''))))"
_SQL_SECTIONS = "list_transform({0}, lambda s: sha256('s' || array_to_string(s, '')))"
_SQL_LEAVES = "list_distinct(flatten(flatten(list_transform({0}, lambda s: list_transform(s, lambda p: p.runs)))))"
_SQL_NEAR = "CASE WHEN len({0}) + len({1}) = 0 THEN 1.0 ELSE len(list_intersect({0}, {1}))::DOUBLE / (len({0}) + len({1}) - len(list_intersect({0}, {1}))) END"

ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, coalesce(lead(text) OVER o, first_value(text) OVER o) AS next_text FROM d
      WINDOW o AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
x AS (SELECT doc_id, text, next_text, length(text) AS n_chars,
      substr(text, 1, length(text) - length(text) // 3) || substr(next_text, 1, length(text) // 3) AS edited FROM n),
y AS (SELECT doc_id, n_chars, edited, {_SQL_TREE.format('text')} AS t, {_SQL_TREE.format('edited')} AS e,
      {_SQL_TREE.format('next_text')} AS f FROM x),
z AS (SELECT *, {_SQL_NODES.format('t')} AS tp, {_SQL_NODES.format('e')} AS ep,
      {_SQL_LEAVES.format('t')} AS b, {_SQL_LEAVES.format('e')} AS eb, {_SQL_LEAVES.format('f')} AS nb FROM y),
s AS (SELECT *, {_SQL_SECTIONS.format('tp')} AS ts, {_SQL_SECTIONS.format('ep')} AS es FROM z),
r AS (SELECT *, flatten(list_filter(tp, lambda q, i: NOT list_contains(es, ts[i]))) AS rest,
      flatten(list_filter(ep, lambda q, i: NOT list_contains(ts, es[i]))) AS entered FROM s)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, sha256('r' || array_to_string(ts, '')) AS fingerprint,
  sha256('r' || array_to_string(es, '')) AS edited_fingerprint, {_SQL_NEAR.format('b', 'eb')} AS near_edited,
  {_SQL_NEAR.format('b', 'nb')} AS near_next, CAST(len(list_filter(entered, lambda p: NOT list_contains(rest, p))) AS INTEGER) AS edited_paragraphs
FROM r"""
