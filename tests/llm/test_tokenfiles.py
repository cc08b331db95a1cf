from __future__ import annotations

from pathlib import Path

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from msglog.llm import tokenfiles
from msglog.llm.common import shared_dir
from msglog.llm.packing import default_tokenizer


def brute(ids, end):
    out, start = [], 0
    for at, x in enumerate(ids):
        if x == end:
            out.append((len(out), start, at - start, True))
            start = at + 1
    if start < len(ids):
        out.append((len(out), start, len(ids) - start, False))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(files=st.lists(st.lists(st.sampled_from([1, 2, 9]), max_size=30), min_size=1, max_size=3), block=st.integers(1, 8))
def test_scan_agrees_with_a_walk(spark, tmp_path, files, block):
    for i, ids in enumerate(files):
        np.array(ids, dtype="<u2").tofile(tmp_path / f"{i}.tokens")
    listed = spark.createDataFrame([(f"{i}.tokens", 2 * len(ids)) for i, ids in enumerate(files)], "file string, bytes long")
    got = sorted(tuple(r) for r in tokenfiles.count_tokens(listed, str(tmp_path), end_id=9, block_tokens=block).collect())
    assert got == sorted((f"{i}.tokens", *doc) for i, ids in enumerate(files) for doc in brute(ids, 9))


@pytest.mark.parametrize("block", [13, 1_000_000])
def test_documents_keep_their_counts(odd, block):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(default_tokenizer())
    got = sorted(((r.doc_id or 0, r.n_tokens) for r in tokenfiles.documents_counted(odd, block).collect()))
    assert got == sorted((r.doc_id or 0, len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect())


def test_the_separator_written_in_a_text_is_text(spark):
    docs = spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string")
    rows = tokenfiles.documents_counted(docs).collect()
    assert len(rows) == 1 and rows[0].n_tokens > 3


def test_files_are_flat_and_roll_over(spark, odd):
    folder = shared_dir(spark, "tokens")
    written = tokenfiles.write_token_files(odd.coalesce(1), folder, file_bytes=1000)
    sizes = {r.file: r.bytes for r in written.groupBy("file").agg({"bytes": "max"}).withColumnRenamed("max(bytes)", "bytes").collect()}
    assert len(sizes) > 1
    for name, size in sizes.items():
        assert Path(folder.removeprefix("file:"), name).stat().st_size == size


def test_no_documents(none):
    assert tokenfiles.documents_counted(none).count() == 0


def test_blocks_are_dealt_over_tasks(spark, tmp_path):
    np.zeros(4000, dtype="<u2").tofile(tmp_path / "0.tokens")
    listed = spark.createDataFrame([("0.tokens", 8000)], "file string, bytes long")
    blocks = tokenfiles.scan_blocks(listed, str(tmp_path), end_id=9, block_tokens=100)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    tasks = blocks.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 1 and blocks.count() == 40
