"""Token counts of documents in flat, unindexed token files, by a separator scan.

A token file is nothing but ids, little-endian and of one width, each document followed by the
end-of-document id. Files are cut into blocks of ``block_tokens`` ids, without regard to documents.
A task reads a block by its range and finds the separators by one vectorised comparison. A block
reports its size and the places of its separators; a prefix scan over a file's blocks adds up sizes
and separators and carries the place of the last separator on, so a document that begins in one
block and ends in another, or spans many, gets its place and length.

Scale: tasks hold one block. The scan is a window over the blocks of one file, a row each; a file
of 100 GB has 50,000. Documents are numbered within their file, so files need no order. Token files
lie in the shared folder, written and read through ``pyarrow.fs``; the writer's file names hold the
task attempt, and only files of attempts that Spark committed are listed.

Defined cases: NULL and empty texts are a document of no tokens; the end-of-document token written
out in a text is ordinary text; what follows a file's last separator is an unfinished document
(``ended`` false); an empty file or table gives no rows; repeated rows are documents each; a text longer
than a block ends in a later one; columns but id and text are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msglog.llm.common import partitions, saved, shared_dir
from msglog.llm.packing import ByteTokenizer, default_tokenizer

END_ID = 50_256
WIDTH = 2  # bytes of an id: this vocabulary has fewer than 65,536
BLOCK_TOKENS = 1_000_000
# Blocks that a task reads, one after the other.
BLOCKS_PER_TASK = 64
FILE_BYTES = 256 * 1024 * 1024

WRITTEN = "doc_id long, file string, document long, bytes long"


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID,
                      width: int = WIDTH, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Tokenise ``docs(doc_id, text)`` into flat files of ``folder``. Returns who lies where, in
    order: (doc_id, file, document number in the file, bytes of the file up to its end)."""
    path = tokenizer or default_tokenizer()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, coder = TaskContext.get(), ByteTokenizer(path, special=False)
        store, base = pafs.FileSystem.from_uri(folder)
        end = np.array([end_id], dtype=f"<u{width}").tobytes()
        out, name, at, number, made = None, "", 0, 0, 0
        for batch in batches:
            rows: list[tuple] = []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), coder.ids(texts), strict=True):
                if out is None:
                    name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{made:04d}.tokens"
                    store.create_dir(base, recursive=True)
                    out, at, number, made = store.open_output_stream(f"{base}/{name}", compression=None), 0, 0, made + 1
                flat = np.frombuffer(ids, dtype="<u4").astype(f"<u{width}").tobytes() + end
                out.write(flat)
                at += len(flat)
                rows.append((doc_id, name, number, at))
                number += 1
                if at >= file_bytes:
                    out.close()
                    out = None
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)],
                                                 names=["doc_id", "file", "document", "bytes"])
        if out is not None:
            out.close()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return saved(rows.mapInArrow(step, WRITTEN), "written")


def scan_blocks(files: DataFrame, folder: str, end_id: int = END_ID, width: int = WIDTH,
                block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Rows (file, block, tokens, ends) of ``files(file, bytes)``: sizes and separator places."""
    step_bytes = block_tokens * width
    count = F.ceil(F.col("bytes") / step_bytes).cast("long")
    blocks = (files.where("bytes > 0").select("file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("block"))
              .select("file", "block", F.least(F.lit(step_bytes).cast("long"), F.col("bytes") - F.col("block") * step_bytes).alias("size")))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for file, block, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with store.open_input_file(f"{base}/{file}") as opened:
                    ids = np.frombuffer(opened.read_at(size, block * step_bytes), dtype=f"<u{width}")
                ends = np.flatnonzero(ids == end_id).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([block]), pa.array([len(ids)]), pa.array([ends.tolist()], pa.list_(pa.int32()))],
                    names=["file", "block", "tokens", "ends"])

    # A row stands for a block of bytes: the number of tasks follows the blocks, not the size of the rows.
    n_blocks = files.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    tasks = max(1, min(n_blocks, max(partitions(files), -(-n_blocks // BLOCKS_PER_TASK))))
    return blocks.repartition(tasks, "file", "block").mapInArrow(step, "file string, block long, tokens long, ends array<int>")


def stitch(blocks: DataFrame) -> DataFrame:
    """Documents (file, document, start, n_tokens, ended) from the blocks of files."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scanned = blocks.select(
        "file", "block", "tokens", "ends",
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("documents"))
    # Where the document that is open at the block's begin starts: behind the last separator so far.
    last = F.when(F.size("ends") > 0, F.col("base") + F.element_at("ends", -1) + 1)
    scanned = scanned.withColumn("open", F.coalesce(F.max(last).over(before), F.lit(0).cast("long")))
    ended = scanned.select("file", "documents", "base", "open", "ends", F.posexplode("ends").alias("i", "end")).select(
        "file", (F.col("documents") + F.col("i")).alias("document"),
        F.when(F.col("i") == 0, F.col("open")).otherwise(F.col("base") + F.get("ends", F.col("i") - 1) + 1).alias("start"),
        (F.col("base") + F.col("end")).alias("stop"), F.lit(True).alias("ended"))
    size = F.col("base") + F.col("tokens")
    rest = scanned.groupBy("file").agg(F.max(size).alias("stop"), F.max(F.coalesce(last, "open")).alias("start"),
                                       F.sum(F.size("ends")).alias("document"))
    rest = rest.where("start < stop").select("file", "document", "start", "stop", F.lit(False).alias("ended"))
    return ended.union(rest).select("file", "document", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), "ended")


def count_tokens(files: DataFrame, folder: str, end_id: int = END_ID, width: int = WIDTH,
                 block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Token counts of all documents in ``files(file, bytes)``."""
    return stitch(saved(scan_blocks(files, folder, end_id, width, block_tokens), "blocks"))


def documents_counted(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Write documents to token files, then count them there: (doc_id, file, document, start, n_tokens)."""
    folder = shared_dir(docs.sparkSession, "tokens")
    written = write_token_files(docs, folder)
    files = written.groupBy("file").agg(F.max("bytes").alias("bytes"))
    counted = count_tokens(files, folder, block_tokens=block_tokens).drop("ended")
    return written.select("doc_id", "file", "document").join(counted, ["file", "document"])
