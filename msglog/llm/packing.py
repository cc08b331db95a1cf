"""Best-fit packing of tokenised documents into sequences of fixed length.

Method: bounded-space online best-fit. Pieces arrive one after the other; at most ``open_bins``
sequences are open. The free spaces of the open sequences are a bitset (bit f is set when some open
sequence has f free tokens), so the fullest sequence that still takes a piece is the lowest set bit
at or above the piece's length. When a new sequence would exceed the bound, the fullest closes.

A document's ids end with ``end_id``. Only documents longer than ``length`` are cut: the remainder
comes first (piece 0, shorter), all later pieces are whole sequences, so they never share one.

Scale: only (row, piece, length) goes through the one shuffle; texts are tokenised where they are
read. Packing tasks are independent and take about ``pieces_per_task`` pieces each, in falling
length, which fills all but the last sequences of a task; what is lost per piece stays the same at
every size.

Defined cases: NULL and empty texts are one token (``end_id``); repeated rows are packed each; an
empty table gives no rows; further columns of the input are ignored, whatever their names; a text of any
length is cut into whole pieces and one shorter one; of equally long pieces the order is that of their
task, id, place and checksum, and of open sequences with equal space the one last used is taken.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msglog.llm.common import saved

LENGTH = 2048
OPEN_BINS = 32_768
PIECES_PER_TASK = 65_536
# Words a worker remembers before it starts afresh, and texts whose unseen words it encodes together.
MEMO = 500_000
BATCH = 250

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class ByteTokenizer:
    """Byte-level BPE from a ``tokenizers`` file, with the ids that library gives.

    Its pre-tokenizer starts a new piece at every space that follows a non-space, so a text without
    two white spaces in a row can be encoded word by word, and equal words share one encoding. The
    words a worker has not met are joined and encoded in one call; a token that begins with a space
    begins a word. Texts with runs of white space or a special token are encoded as a whole.
    """

    def __init__(self, path: str, special: bool = True):
        """``special``: whether special tokens written in a text get their own ids, or are text."""
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = not special
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._special = [t["content"] for t in spec.get("added_tokens", [])] if special else []
        self._runs = re.compile(r"\s\s")
        vocabulary = spec["model"]["vocab"]
        self._begins = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._begins[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True  # its sign for a space
        self._fast = self._ranks(path)
        self._memo: dict[str, bytes] = {}

    @staticmethod
    def _ranks(path: str):
        """The same vocabulary as ranks, if it lies beside the file: the same ids, sooner."""
        beside = Path(path).with_suffix(".tiktoken")
        if not beside.exists():
            return None
        import public_tokenizers
        import tiktoken

        with open(beside, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _encode(self, text: str) -> np.ndarray:
        if self._fast and not any(s in text for s in self._special):
            return np.array(self._fast.encode_ordinary(text), dtype="<u4")
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn(self, unseen: list[str]) -> None:
        if len(self._memo) + len(unseen) > MEMO:
            self._memo.clear()
        ids = self._encode(" " + " ".join(unseen))
        at = np.append(np.flatnonzero(self._begins[ids]), len(ids)) * 4
        flat, bounds = ids.tobytes(), at.tolist()
        self._memo.update(zip(unseen, (flat[a:b] for a, b in zip(bounds, bounds[1:], strict=False)), strict=True))

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        plain = [not self._runs.search(t) and not any(s in t for s in self._special) for t in texts]
        for first in range(0, len(texts), BATCH):
            part = [t.split(" ") if ok else None
                    for t, ok in zip(texts[first:first + BATCH], plain[first:first + BATCH], strict=True)]
            wanted = set().union(*(p[1:] for p in part if p))
            unseen = [w for w in wanted if w not in self._memo]
            if unseen:
                if len(self._memo) + len(unseen) > MEMO:
                    unseen = list(wanted)
                self._learn(unseen)
            get = self._memo.__getitem__
            for text, p in zip(texts[first:first + BATCH], part, strict=True):
                if p is None:
                    yield self._encode(text).tobytes()
                else:
                    yield self._encode(p[0]).tobytes() + b"".join(map(get, p[1:]))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end_id: int = 0,
           with_ids: bool = False) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32[, ids]) of ``docs(doc_id, text)``."""
    path = tokenizer or default_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = ByteTokenizer(path), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, got in zip(batch.column(0).to_pylist(), coder.ids(texts), strict=True):
                ids = memoryview(got + end)
                n = len(ids) // 4
                start, piece = 0, 0
                while start < n:
                    size = length if start else (n - 1) % length + 1
                    part = ids[4 * start:4 * (start + size)]
                    rows.append((doc_id, piece, start, size, zlib.crc32(part), bytes(part) if with_ids else None))
                    start, piece = start + size, piece + 1
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            keep = 6 if with_ids else 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:keep], types, strict=False)],
                                             names=names[:keep])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(cut, PIECES + (", ids binary" if with_ids else "")))


def best_fit(lengths: np.ndarray, length: int = LENGTH, open_bins: int = OPEN_BINS) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, in order of arrival."""
    free_of: list[list[int]] = [[] for _ in range(length + 1)]  # open sequences by free space
    sequence, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    bits, opened, made = 0, 0, 0
    for i, need in enumerate(lengths.tolist()):
        fits = bits >> need
        if fits:
            free = need + (fits & -fits).bit_length() - 1
            at = free_of[free].pop()
            if not free_of[free]:
                bits ^= 1 << free
        else:
            free, at, made = length, made, made + 1
            if need < length:
                if opened == open_bins:  # the fullest closes
                    fullest = (bits & -bits).bit_length() - 1
                    free_of[fullest].pop()
                    if not free_of[fullest]:
                        bits ^= 1 << fullest
                else:
                    opened += 1
        sequence[i], offset[i] = at, length - free
        left = free - need
        if left:
            free_of[left].append(at)
            bits |= 1 << left
        elif free < length:
            opened -= 1
    return sequence, offset


def pack(pieces: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS,
         pieces_per_task: int = PIECES_PER_TASK) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the rows of :func:`pieces`.

    The pieces are staged in the shared folder first, so a lost executor repeats the packing of the
    same rows. Sequences are numbered within their packing task, the task's number in the high bits.
    """
    staged = saved(pieces, "pieces")
    # A whole piece is a sequence by itself and stays where it is; those numbers are below zero.
    whole = staged.where(F.col("length") == length).withColumns(
        {"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    staged = staged.where(F.col("length") < length)
    count = staged.count()
    tasks = max(1, -(-count // pieces_per_task))

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [b for b in batches if len(b)]
        if rows:  # slots that share a partition share sequences; the smallest slot names them
            frame = pd.concat(rows, ignore_index=True)
            sequence, offset = best_fit(frame["length"].to_numpy(), length, open_bins)
            frame["sequence_id"] = (int(frame["slot"].min()) << 33) + sequence
            frame["offset"] = offset
            yield frame.drop(columns="slot")

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in staged.schema.fields)
    # A hash of the row deals short and long pieces evenly; the order makes every attempt pack alike.
    mixed = staged.withColumn("slot", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(tasks)))
    packed = (mixed.repartition(tasks, "slot").sortWithinPartitions(F.desc("length"), "slot", "doc_id", "piece", "ids_crc32")
              .mapInPandas(fill, columns + ", sequence_id long, offset long"))
    return packed.unionByName(whole)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH) -> DataFrame:
    """Pieces of all documents with their place in a sequence."""
    return pack(pieces(docs, tokenizer, length), length)
