"""WARC archives with a two-level capture index.

Archives: every page is a record, compressed on its own, so it can be read by a range. Of pages with
one payload of ``MIN_SHARED`` bytes or more, that with the largest id is a response, the others are
revisits of it: their HTTP header is kept, their payload is not.

Index: a line for each capture, keyed by the url with its host reversed (``org,example)/path``) and
the page id. Lines are sorted and cut into compressed blocks of ``BLOCK_LINES``; the sparse directory
holds the first key of each block. A look-up finds its blocks in the directory by binary search, its
lines in the blocks by binary search, and reads the archive by the lines' ranges.

Scale: a payload is moved at most once, to find its copies; the copies' digests are counted first,
so a payload held by a third of the pages is one row of the other side of that join. Keys hold the
page id, so the captures of one url or host spread over blocks. The directory is sent to the tasks
while it is under ``MAX_DIRECTORY`` bytes, measured; beyond that the blocks are opened and joined.
Archives and index lie in the shared folder, through ``pyarrow.fs``, which reaches local, HDFS and
object stores. File names hold the task attempt, and only files of attempts that Spark committed are
in the index, so a repeated task leaves no wrong record behind.

Defined cases: a NULL html is an empty payload; a NULL url has the empty key, a NULL id the empty
number; repeated rows are captures each, those that share the largest id are all responses; an
empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msglog.llm.common import partitions, saved, shared_dir

MIN_SHARED = 1000
BLOCK_LINES = 3000
ARCHIVE_BYTES = 64 * 1024 * 1024
READ_SPAN = 8 * 1024 * 1024
READ_BYTES = 64 * 1024 * 1024  # of records that a task reads
MAX_DIRECTORY = 64 * 1024 * 1024
DATE = "1970-01-01T00:00:00Z"  # pages carry no capture time


def surt(url: str | None) -> str:
    """The sort key of a url: host labels reversed, then the rest, escaped."""
    # Spaces, line ends and braces end the parts of an index line.
    url = re.sub(r"[ \n{]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head, mark, rest = url.partition("://")
    if not mark:
        return head
    host = re.match(r"[^/?#]*", rest)[0]
    return ",".join(reversed(host.lower().split("."))) + ")" + rest[len(host):]


def capture_key(url: str | None, page_id: int | None) -> str:
    """The index key of one capture; spaces only end its parts."""
    number = "" if page_id is None else f"{page_id + (1 << 63):020d}"
    return f"{surt(url)} {number} "


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    sha = base64.b32encode(bytes.fromhex(digest)).decode()
    uri = re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url or "")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{sha}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    squeezed = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeezed.compress(raw) + squeezed.flush()


def parse_record(member: bytes) -> dict:
    """Headers and payload of one compressed record: page_id, payload_bytes, payload_digest,
    record_type, refers_to, payload (None for revisits). A response whose payload does not have its
    digest raises."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    named = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:] if ": " in line)
    block = rest[:int(named["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = base64.b32decode(named["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    revisit = named["WARC-Type"] == "revisit"

    def number(header: str) -> int | None:
        found = named.get(header, "")[len("<urn:page:"):-1]
        return int(found) if found else None

    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record of page {number('WARC-Record-ID')} is damaged")
    return {"page_id": number("WARC-Record-ID"), "payload_bytes": size, "payload_digest": digest,
            "record_type": "revisit" if revisit else "response", "refers_to": number("WARC-Refers-To"),
            "payload": None if revisit else payload}


def planned(pages: DataFrame) -> DataFrame:
    """Pages with their digest and the page they revisit, if any."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    shared = (rows.where(F.octet_length("payload") >= MIN_SHARED).groupBy("digest")
              .agg(F.max("page_id").alias("original"), F.count("*").alias("copies")).where("copies > 1"))
    joined = rows.join(shared, "digest", "left")
    revisits = F.col("original").isNotNull() & ~F.col("original").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "payload", "digest", F.when(revisits, F.col("original")).alias("refers_to"))


CAPTURES = "key string, archive string, offset long, length long"


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write the archives of ``pages(page_id, url, html)``; the captures (key, archive, offset,
    length), from files in the shared folder."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        store, base = pafs.FileSystem.from_uri(folder)
        out, name, at, made = None, "", 0, 0
        for batch in batches:
            rows: list[tuple] = []
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{made:04d}.warc.gz"
                    store.create_dir(base, recursive=True)
                    out, at, made = store.open_output_stream(f"{base}/{name}", compression=None), 0, made + 1
                record = _record(page_id, url, payload, digest, refers_to)
                out.write(record)
                rows.append((capture_key(url, page_id), name, at, len(record)))
                at += len(record)
                if at >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)],
                                                 names=["key", "archive", "offset", "length"])
        if out is not None:
            out.close()

    return saved(planned(pages).mapInArrow(step, CAPTURES), "captures")


BLOCKS = "block long, first_key string, lines binary"


def build_index(captures: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Compressed blocks of sorted lines, with the first key of each."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[str] = []

        def flush(lines: list[str]) -> pa.RecordBatch:
            packed = zlib.compress("\n".join(lines).encode("utf-8", "surrogatepass"), 6)
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([lines[0].split("{")[0]]), pa.array([packed])],
                                              names=["block", "first_key", "lines"])

        for batch in batches:
            held += [key + json.dumps({"a": a, "o": o, "n": n})
                     for key, a, o, n in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            while len(held) >= block_lines:
                yield flush(held[:block_lines])
                held, number = held[block_lines:], number + 1
        if held:
            yield flush(held)

    rows = captures.repartitionByRange(partitions(captures), "key", "archive", "offset")
    return saved(rows.sortWithinPartitions("key", "archive", "offset").mapInArrow(step, BLOCKS), "index")


def _lines(packed: bytes) -> list[str]:
    return zlib.decompress(packed).decode("utf-8", "surrogatepass").split("\n")


def look_up(blocks: DataFrame, prefixes: DataFrame, max_directory: int = MAX_DIRECTORY) -> DataFrame:
    """Captures (archive, offset, length) whose key starts with one of ``prefixes(prefix)``: a
    :func:`capture_key`, or :func:`surt` and a space for all captures of a url."""
    size = blocks.agg(F.coalesce(F.sum(F.octet_length("first_key") + 8), F.lit(0))).first()[0]
    wanted = prefixes.select("prefix").distinct()
    found = "archive string, offset long, length long"

    def captures(lines: list[str]) -> list[tuple]:
        return [(x["a"], x["o"], x["n"]) for x in (json.loads(line[line.index("{"):]) for line in lines)]

    if size > max_directory:
        def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for packed in batch.column(0):
                    lines = _lines(packed.as_py())
                    keys = [line.split("{")[0] for line in lines]
                    rows = [(p, *c) for k, c in zip(keys, captures(lines), strict=True) for p in {k, k[:k.rindex(" ", 0, -1) + 1]}]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)],
                                                     names=["prefix", "archive", "offset", "length"])

        return (blocks.select("lines").mapInArrow(opened, "prefix string, " + found)
                .join(wanted, "prefix").drop("prefix").distinct())

    directory = sorted((r.first_key, r.block) for r in blocks.select("first_key", "block").collect())  # bounded by max_directory
    sent = blocks.sparkSession.sparkContext.broadcast(([k for k, _ in directory], [b for _, b in directory]))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, numbers = sent.value
        for batch in batches:
            rows = []
            for prefix in batch.column(0).to_pylist():
                first = max(0, bisect.bisect_left(keys, prefix) - 1)
                for at in range(first, bisect.bisect_right(keys, prefix + "\U0010ffff")):
                    rows.append((numbers[at], prefix))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["block", "prefix"])

    def search(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        if len(asked) and len(block):
            lines = _lines(block["lines"].iloc[0])
            for prefix in asked["prefix"]:
                low = bisect.bisect_left(lines, prefix)
                high = bisect.bisect_left(lines, prefix + "\U0010ffff", lo=low)
                rows += captures(lines[low:high])
        return pd.DataFrame(rows, columns=["archive", "offset", "length"])

    located = wanted.mapInArrow(locate, "block long, prefix string")
    return (located.groupBy("block").cogroup(blocks.select("block", "lines").groupBy("block"))
            .applyInPandas(search, found).distinct())


RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_records(captures: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Read captures by their ranges, neighbours of an archive together."""
    names = [c.split()[0] for c in RECORDS.split(", ")] + (["payload"] if payloads else [])
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()] + ([pa.binary()] if payloads else [])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        opened, name = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True):
                if archive != name:
                    if opened is not None:
                        opened.close()
                    opened, name = store.open_input_file(f"{base}/{archive}"), archive
                rows.append(parse_record(opened.read_at(length, offset)))
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, kinds, strict=True)], names=names)
        if opened is not None:
            opened.close()

    # A capture is a narrow row that stands for its record: the number of tasks follows the records' bytes.
    captures = saved(captures.select("archive", "offset", "length"), "captures")
    size = captures.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    near = F.floor(F.col("offset") / READ_SPAN)
    return (captures.repartition(max(partitions(captures), -(-size // READ_BYTES)), "archive", near).sortWithinPartitions("archive", "offset")
            .mapInArrow(step, RECORDS + (", payload binary" if payloads else "")))


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write all pages, index them, look every page up and read its record back."""
    folder = shared_dir(pages.sparkSession, "warc")
    blocks = build_index(write_archives(pages, folder))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([capture_key(u, i) for i, u in zip(*(c.to_pylist() for c in batch.columns), strict=True)],
                                                       pa.string())], names=["prefix"])

    wanted = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")).mapInArrow(keys, "prefix string")
    return read_records(look_up(blocks, wanted), folder)
