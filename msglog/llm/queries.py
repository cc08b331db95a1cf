"""The registered queries of the training-data operators, with the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msglog.llm import chunks, decontaminate, hmm, merkle, minhash, packing, ranked, simhash, tokenfiles, toxicity, urls, vafile, warc
from msglog.llm.common import fold, prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


@_query("op9_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@_query("op7_simhash_classes")
def simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_classes(table(spark, sf_dir, "documents"), "doc_id", k=3, radius=3)
    return found.select(F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"),
                        F.col("class").alias("component_id"))


@_query("op2_ftrl_toxicity")
def ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id")) != 0)
    return toxicity.score(docs, model).select(
        F.col("key").alias("doc_id"), (fold(F.col("key")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query("op10_gear_chunk_repeats")
def gear_chunk_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunks.repeated_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "kept", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"),
                        "start_byte", "end_byte", "copies", "first_doc_id")


@_query("op3_merkle_fingerprints", merkle.ORACLE)
def merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edited_copies(table(spark, sf_dir, "documents"))


# (host, path, verdict) of the registered query: fixed values.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@_query("op4_url_digest_filter", """
WITH r(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
  row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS k
  FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM f WHERE k = 1""")
def url_digest_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, sf_dir, "pages"), rules).withColumnRenamed("key", "page_id")


@_query("op6_seeded_alignment")
def seeded_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("key", "doc_id")


@_query("op1_hmm_scores")
def hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.scores(table(spark, sf_dir, "documents"), fold(F.col("doc_id")) == 1)


@_query("op5_warc_capture_index", """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN original END AS refers_to FROM g""")
def warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


@_query("op8_separator_scan")
def separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.documents_counted(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_tokens", "file", "document", "start")


@_query("op11_minhash_classes", """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
g AS (SELECT doc_id, unnest(s) AS g FROM s),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN m USING (doc_id)""")
def minhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_classes(table(spark, sf_dir, "documents"), k=4, num=4, den=5)
    return found.select(F.col("key").alias("doc_id"), "n_shingles", F.col("class").alias("component_id"),
                        F.col("key").eqNullSafe(F.col("class")).alias("kept"))


_ROUND = """
a{i} AS (SELECT vec_id, v, c, d FROM (SELECT vec_id, v, c, CAST(list_sum(list_transform(range(1, 65), lambda i: (v[i] - m[i]) * (v[i] - m[i])))
    AS BIGINT) AS d FROM v, c{i}) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)"""
_MOVE = """,
u{i} AS (SELECT c, i, CAST(floor(sum(v[i]) / count(*)) AS BIGINT) AS x FROM a{i}, range(1, 65) AS t(i) GROUP BY c, i),
c{j} AS (SELECT c, list(x ORDER BY i) AS m FROM u{i} GROUP BY c UNION ALL SELECT c, m FROM c{i} WHERE c NOT IN (SELECT c FROM a{i})),"""


@_query("op12_vafile_clusters", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, v AS m FROM v QUALIFY c < 16),"""
        + "".join(_ROUND.format(i=i) + (_MOVE.format(i=i, j=i + 1) if i < 3 else "") for i in range(4)) + """
SELECT vec_id, CAST(a3.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a3.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256 FROM a3 JOIN c3 ON a3.c = c3.c""")
def vafile_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.clusters(table(spark, sf_dir, "embeddings"), n=16, rounds=3, salt="1:").drop("compared")


@_query("op13_ranked_search", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
x AS (SELECT doc_id, len(t) AS n, t FROM d WHERE len(t) > 0),
s AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM x),
f AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS t FROM x) GROUP BY doc_id, n, t),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f, s GROUP BY t, big_n),
q AS (SELECT item_id, t, count(*) AS k FROM (SELECT item_id, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY item_id, t),
r AS (SELECT item_id, doc_id, CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM q JOIN f USING (t) JOIN w USING (t), s GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 20""")
def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=20).withColumnRenamed("item", "item_id")
