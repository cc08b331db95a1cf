"""Cleans a corpus for training in stages; every stage reads what the one before has written.

Each stage is one operator of ``msglog.llm`` over all documents that its predecessor kept. Stages but
the last return the columns of documents; ``n_chars`` follows the text. NULL texts stay, as empty
ones do, but of all texts without words one row stays (they are copies of each other). Of rows that are
equal in id and text one stays; of copies with several ids the smallest id, and of several texts with that
id the one whose hash is smallest. Texts of any length are read whole. Further columns are carried along,
whatever their names. An empty table stays empty. Labels and benchmark items come from the tables beside
the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msglog.llm import chunks, decontaminate, packing, simhash, toxicity
from msglog.llm.common import fold, prepare, saved, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    prepare(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id")) != 0)
    return toxicity.accepted(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: five-word shingles, similarity 0.8 or more."""
    prepare(spark)
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose repeated passages stand in their first place only."""
    prepare(spark)
    cut = chunks.without_repeats(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in cut.columns else cut


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    prepare(spark)
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_benchmark_copies),
    ("best-fit packing", pack),
]

# SQL cannot express the learned and hashed stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


QUERY = {"pipeline": run}
