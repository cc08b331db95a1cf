from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
import pytest
import xxhash

from msglog.llm import queries, urls

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
SMALL = "/root/testdata/sf0.001"
RULES = "host string, path string, verdict string"


def test_query_agrees_with_its_sql(spark):
    from check_oracles import compare, connect

    name = "op4_url_digest_filter"
    assert compare(queries.QUERIES[name](spark, SMALL), connect(SMALL), queries.ORACLES[name]) is None


@pytest.mark.parametrize("max_bytes", [0, 1 << 20])
def test_longest_rule_wins_on_both_ways(spark, max_bytes):
    rows = [(1, "http://A.b.Org/es/x"), (2, "https://org"), (3, "http://xorg/es/"), (4, None), (5, "no scheme"), (6, "ftp://b.org?q=/es/"),
            (7, "http://b.org/é/1#f"), (8, "http:///es/"), (9, "x://b.org/es/a://c"), (1, "http://A.b.Org/es/x"), (None, "http://q.net/")]
    rules = [("org", "/", "allow"), ("b.org", "/es/", "block"), ("b.org", "/é", "block"), ("b.org", "/é", "allow"), (None, "/es/", "block"),
             ("net", None, "block"), ("a.b.org", "/es/", "allow")]
    pages = spark.createDataFrame([(*r, 1, "h") for r in rows], "page_id long, url string, key int, host string")
    got = urls.judge(pages, spark.createDataFrame(rules, RULES), max_bytes=max_bytes).collect()
    assert sorted(((r.key or 0), r.host, r.path, r.rule, r.verdict) for r in got) == [
        (0, "q.net", "/", "net", "block"), (1, "a.b.org", "/es/x", "a.b.org/es/", "allow"), (1, "a.b.org", "/es/x", "a.b.org/es/", "allow"),
        (2, "org", "", None, "allow"), (3, "xorg", "/es/", None, "allow"), (4, "", "", None, "allow"), (5, "", "", None, "allow"),
        (6, "b.org", "", None, "allow"), (7, "b.org", "/é/1", "b.org/é", "block"), (8, "", "/es/", "/es/", "block"),
        (9, "b.org", "/es/a://c", "b.org/es/", "block")]


def test_empty_lists_and_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    rules = spark.createDataFrame([], RULES)
    assert urls.judge(pages, rules, default="block").first().verdict == "block"
    assert urls.judge(pages.limit(0), rules).count() == 0


def test_collisions_are_confirmed(tmp_path, monkeypatch):
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda key, seed=0: len(key) % 3)
    rules = [(f"h{i}", f"/p{j}", i % 2 == 0) for i in range(12) for j in range(5)]
    path = str(tmp_path / "rules")
    urls.DigestArray.write(path, rules)
    array = urls.DigestArray(path)
    assert isinstance(array.digest, np.memmap)
    for host, tail, block in rules:
        found = int(array.find([(host + tail).encode()], [len(host)])[0])
        assert found >= 0 and bool(array.block[found]) == block
    assert array.find([b"h1/p9", b"nothing"], [2, 3]).tolist() == [-1, -1]


@pytest.mark.parametrize("max_bytes", [0, 1 << 20])
def test_length_is_counted_in_characters_on_both_ways(spark, max_bytes):
    rules = spark.createDataFrame([("org", "/éé", "block"), ("ab.org", "/", "allow")], RULES)
    pages = spark.createDataFrame([(1, "http://ab.org/éé/x"), (2, "http://ab.org/é")], "page_id long, url string")
    got = {r.key: (r.rule, r.verdict) for r in urls.judge(pages, rules, max_bytes=max_bytes).collect()}
    assert got == {1: ("ab.org/", "allow"), 2: ("ab.org/", "allow")}
