"""URL filters on a sorted digest array.

A rule is (host, path, verdict); it fits its host and all subdomains if the url's path starts with
the rule's path, and the longest rule that fits wins (on equal length, the one with the longer
host). A url no rule fits gets the list's default verdict.

Method: rules become keys ``host + path``. The array file holds the sorted 64-bit XXH64 digests of
the keys and, in the same order, where their strings lie and their verdicts. Every task maps the
file into memory, so tasks of a machine share its pages, hashes all (host suffix, path prefix) keys
of its urls, finds them by a vectorised binary search, and confirms the stored strings, so digests
that collide cost a comparison and never a wrong verdict. Prefixes are only taken at the lengths
that the rules' paths have.

Scale: urls are judged where they are read, without a shuffle. The array is bounded: rules are
counted and measured, up to ``MAX_BYTES`` they are shipped as a file. Longer lists are joined
instead: distinct candidate keys, made by the same rules, meet the list in an equality join on the
key, so neither a common host nor the list's size weighs on a task.

Defined cases: a NULL url or one without ``://`` has empty host and path, which only a rule with an
empty host would fit; rules with a NULL host or path count it as empty; a rule given twice with two
verdicts blocks; an empty list gives every url the default; extra columns are left out.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BYTES = 32 * 1024 * 1024
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a url."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


class DigestArray:
    """The sorted digest array, mapped from a file: a header of counts, digests, offsets, hosts'
    lengths, verdicts, the distinct path lengths, then the key strings."""

    def __init__(self, path: str):
        head = np.fromfile(path, dtype="<u8", count=3)
        n, lengths, text = (int(x) for x in head)
        at = 24

        def mapped(kind: str, count: int) -> np.ndarray:
            nonlocal at
            size = np.dtype(kind).itemsize * count
            got = np.memmap(path, dtype=kind, mode="r", offset=at, shape=(count,)) if count else np.zeros(0, dtype=kind)
            at += size
            return got

        self.digest, self.offset = mapped("<u8", n), mapped("<u8", n + 1)
        self.host_bytes, self.block = mapped("<u4", n), mapped("u1", n)
        self.path_lengths, self.text = mapped("<u4", lengths), mapped("u1", text)

    @staticmethod
    def write(path: str, rules: list[tuple[str, str, bool]]) -> None:
        """Write the array of (host, path, blocks) rules."""
        worst: dict[tuple[bytes, bytes], bool] = {}
        for host, tail, block in rules:
            key = (host.encode("utf-8", "surrogatepass"), tail.encode("utf-8", "surrogatepass"))
            worst[key] = worst.get(key, False) or block
        rows = sorted((xxhash.xxh64_intdigest(h + t), h + t, len(h), b) for (h, t), b in worst.items())
        text = b"".join(r[1] for r in rows)
        lengths = sorted({len(t) for _, t in worst})
        with open(path, "wb") as out:
            out.write(np.array([len(rows), len(lengths), len(text)], dtype="<u8").tobytes())
            out.write(np.array([r[0] for r in rows], dtype="<u8").tobytes())
            out.write(np.concatenate(([0], np.cumsum([len(r[1]) for r in rows], dtype="<u8"))).astype("<u8").tobytes())
            out.write(np.array([r[2] for r in rows], dtype="<u4").tobytes())
            out.write(np.array([r[3] for r in rows], dtype="u1").tobytes())
            out.write(np.array(lengths, dtype="<u4").tobytes())
            out.write(text)

    def find(self, keys: list[bytes], host_bytes: list[int]) -> np.ndarray:
        """Position of each key with its host length in the array, or -1."""
        digests = np.array([xxhash.xxh64_intdigest(k) for k in keys], dtype="<u8")
        at = np.searchsorted(self.digest, digests)
        found = np.full(len(keys), -1)
        todo = np.flatnonzero((at < len(self.digest)) & (self.digest[np.minimum(at, len(self.digest) - 1)] == digests)) \
            if len(self.digest) else np.zeros(0, dtype=np.int64)
        for i in todo.tolist():
            j = int(at[i])
            while j < len(self.digest) and self.digest[j] == digests[i]:  # confirm, past collisions
                if self.host_bytes[j] == host_bytes[i] and self.text[self.offset[j]:self.offset[j + 1]].tobytes() == keys[i]:
                    found[i] = j
                    break
                j += 1
        return found


def suffixes(host: bytes) -> list[bytes]:
    """A host and its parent domains, longest first."""
    labels = host.split(b".")
    return [b".".join(labels[i:]) for i in range(len(labels))]


def _judge(array: DigestArray, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[bool | None]]:
    keys, host_bytes, owner = [], [], []
    lengths = array.path_lengths.tolist()
    for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
        tail = path.encode("utf-8", "surrogatepass")
        for part in suffixes(host.encode("utf-8", "surrogatepass")):
            for n in lengths:
                if n <= len(tail):
                    keys.append(part + tail[:n])
                    host_bytes.append(len(part))
                    owner.append(i)
    rule: list[str | None] = [None] * len(hosts)
    block: list[bool | None] = [None] * len(hosts)
    best = [(-1, -1)] * len(hosts)
    found = array.find(keys, host_bytes)
    for c in np.flatnonzero(found >= 0).tolist():
        text = keys[c].decode("utf-8", "surrogatepass")
        # The longest rule has the most characters; of equally long ones, the most in its host.
        i, rank = owner[c], (len(text), len(keys[c][:host_bytes[c]].decode("utf-8", "surrogatepass")))
        if rank > best[i]:
            best[i] = rank
            rule[i], block[i] = text, bool(array.block[found[c]])
    return rule, block


def _sent_file(spark: SparkSession, rows: list) -> str:
    """Write the array on the driver and hand it to all executors; the name they open it by."""
    folder = tempfile.mkdtemp(prefix="urls-")  # of the driver; executors get copies of the file
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    handle, path = tempfile.mkstemp(prefix="rules-", suffix=".digests", dir=folder)
    os.close(handle)
    DigestArray.write(path, [(r.host, r.path, r.verdict == "block") for r in rows])
    spark.sparkContext.addFile(path)
    return Path(path).name


def judge(urls: DataFrame, rules: DataFrame, key: str = "page_id", default: str = "allow",
          max_bytes: int = MAX_BYTES) -> DataFrame:
    """Rows (key, host, path, rule, verdict) of ``urls(key, url)`` under ``rules(host, path, verdict)``."""
    spark = urls.sparkSession
    rules = rules.select(F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    size = rules.agg(F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path") + 21), F.lit(0))).first()[0]
    host, path = split_url(F.col("url"))
    pages = urls.select(F.col(key).cast("long").alias("key"), host.alias("host"), path.alias("path"))
    if size > max_bytes:
        return _joined(pages, rules, default)
    name = _sent_file(spark, rules.collect())  # bounded by max_bytes

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(SparkFiles.get(name))
        for batch in batches:
            rule, block = _judge(array, batch.column(1).to_pylist(), batch.column(2).to_pylist())
            verdict = [default if b is None else "block" if b else "allow" for b in block]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                                             names=["key", "host", "path", "rule", "verdict"])

    return pages.mapInArrow(step, "key long, host string, path string, rule string, verdict string")


def _joined(pages: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same verdicts by an equality join, for lists too long to ship."""
    rules = rules.groupBy("host", "path").agg(F.max(F.col("verdict") == "block").alias("block"))
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]  # at most the longest path's length
    distinct = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    parts = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keys = (distinct.withColumn("part", F.explode(parts)).withColumn("n", F.explode(F.array(*map(F.lit, lengths)).cast("array<int>")))
            .where(F.col("n") <= F.length("path"))
            .select("host", "path", F.col("part").alias("rule_host"), F.expr("substring(path, 1, n)").alias("rule_path")))
    named = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "block")
    rank = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"))
    best = (keys.join(named, ["rule_host", "rule_path"]).groupBy("host", "path")
            .agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "block"), rank).alias("best")))
    return pages.join(best, ["host", "path"], "left").select(
        "key", "host", "path", F.col("best.rule").alias("rule"),
        F.when(F.col("best.block").isNull(), default).when(F.col("best.block"), "block").otherwise("allow").alias("verdict"))
