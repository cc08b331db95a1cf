from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from msglog.llm import queries

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory, prose):
    """Clean texts, toxic ones, near copies, a shared passage and benchmark copies, and odd rows."""
    rng = random.Random(21)
    folder = str(tmp_path_factory.mktemp("corpus"))
    texts, labels, kind = {}, [], {}
    shared = prose(70)
    benchmark = [(i, prose(40)) for i in range(5)]
    for i in range(400):
        words = prose(rng.randint(80, 160)).split()
        kind[i] = "clean"
        if i % 4 == 1:
            words[10] = rng.choice(["scoundrel", "villain"])
            kind[i] = "toxic"
        elif i % 20 == 0:
            words[40:40] = shared.split()
            kind[i] = "shares"
        elif i % 20 == 2:
            words[30:30] = benchmark[i % 5][1].split()
            kind[i] = "benchmark"
        texts[i] = " ".join(words)
        if i % 2:
            labels.append((i, int(kind[i] == "toxic")))
    for i, of in ((1000, 3), (1001, 3), (1002, 7)):
        words = texts[of].split()
        words[50] = "changed"
        texts[i], kind[i] = " ".join(words) if i != 1001 else texts[of], "copy"
    texts |= {2000: None, 2001: "", 2002: "  "}
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, DOCUMENT).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, kind, shared, benchmark[2][1]


def test_each_stage_takes_effect_and_keeps_clean_documents(spark, corpus, tmp_path):
    folder, texts, kind, shared, item = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert out.schema == docs.schema, name
        out.write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        kept.append({r.doc_id: getattr(r, "text", None) for r in docs.collect()})
    of = {k: {i for i, x in kind.items() if x == k} for k in set(kind.values())}
    calm, single, cut, clean, packed = kept
    # 160 labelled rows leave a few texts on the wrong side.
    assert len(set(calm) & of["toxic"]) <= 2 and len(set(texts) - of["toxic"] - set(calm)) <= 6
    assert set(calm) - set(single) == {1000, 1001, 1002, 2001, 2002} & set(calm)
    assert set(cut) == set(single)
    assert sum(shared in t for t in cut.values() if t) == 1 and all(cut[i] == single[i] for i in of["clean"] & set(cut))
    for i in sorted(of["shares"] & set(cut))[1:]:
        assert len(cut[i].split()) <= len(texts[i].split()) - 40
    # Most copies of the item went as a repeated passage; the documents that still held one are gone.
    dropped = set(cut) - set(clean)
    assert dropped and dropped <= of["benchmark"] and not any(item in t for t in clean.values() if t)
    assert set(packed) == set(clean)


def test_run_is_its_registered_query(spark, corpus):
    folder = corpus[0]
    rows = corpus_pipeline.QUERY["pipeline"](spark, folder).collect()
    assert rows and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows[0].asDict())


def test_an_empty_table_and_no_labels_pass_through(spark, corpus, tmp_path):
    folder = str(tmp_path)
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{corpus[0]}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_odd_rows_pass_through_every_stage(spark, corpus, odd, tmp_path, prose):
    """Clashing columns, ties, repeated rows, NULL ids and a very long text, beside clean documents."""
    extra = ["row", "key", "score", "block", "row_key", "cuts", "class", "node"]
    clean = [(10_000 + i, prose(100)) for i in range(20)]
    rows = odd.select("doc_id", "text").union(spark.createDataFrame(clean + clean[:2], "doc_id long, text string"))
    for name in extra:
        rows = rows.withColumn(name, F.lit("x"))
    docs, kept, folder = rows, [], f"{tmp_path}/tables"
    spark.read.parquet(f"{corpus[0]}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    spark.read.parquet(f"{corpus[0]}/labels.parquet").limit(0).write.parquet(f"{folder}/labels.parquet")
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == rows.columns, name
        out.write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        kept.append(docs.collect())
    single = [r.doc_id for r in kept[1]]
    assert sorted(i for i in single if i and i >= 10_000) == [i for i, _ in clean]  # of repeated rows one stays
    assert single.count(5) == 1 and 7 in single and len([i for i in single if i in (1, 2, 3)]) <= 1
    assert {r.doc_id for r in kept[4]} == {r.doc_id for r in kept[3]}
    long = [r for r in kept[4] if r.doc_id == 7]
    assert sum(r.length for r in long) > 30_000 and len(long) > 10


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, len(queries.QUERIES) + 1))
