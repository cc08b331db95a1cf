"""Reads over several streams, registries with intervals, and plan choices that must not matter."""

from __future__ import annotations

import re

import pytest
from fixtures import column, log_of, message
from msglog.operators import discovery, positions, sequence, splits
from msglog.operators.splits import FilterSet, check_no_overlap, match_filters, overlapping
from msglog.sources import store
from msglog.sources.log import read_log
from msglog.sources.store import append_log, shared_dir


@pytest.fixture(scope="module")
def three(spark):
    """Streams A, B and C with sequences 1, 3, 5, ... 19."""
    return log_of(spark, [message(i, f"{s}.{i % 4}", b"x", stream=s) for s in "ABC" for i in range(1, 20, 2)])


def keys(frame):
    return sorted((r.stream, r.streamSeq) for r in frame.collect())


def options(**more):
    return {"headers_only": True, "metadata": ["stream", "streamSeq"], **more}


@pytest.mark.parametrize("top_k", [0, 1000])
def test_limits_and_counts_over_streams_are_exact(spark, three, monkeypatch, top_k):
    monkeypatch.setattr(sequence, "TOP_K_ROWS", top_k)
    first = sorted(((i, s) for s in "ABC" for i in range(1, 20, 2)))[:10]
    want = sorted((s, i) for i, s in first)
    assert keys(read_log(spark, frame=three, **options(limit=10))) == want
    assert keys(read_log(spark, frame=three, **options(stop=("count", 10)))) == want
    assert len(keys(read_log(spark, frame=three, **options(limit=100)))) == 30


def test_stops_are_per_stream_and_split(spark):
    log = log_of(spark, [message(i, "x", stream="A") for i in (1, 5, 9)] + [message(i, "x", stream="B") for i in (1, 7, 9)])
    want = [("A", 1), ("A", 5), ("B", 1), ("B", 7)]
    assert keys(read_log(spark, frame=log, **options(stop=("seq", 4)))) == want
    assert keys(read_log(spark, frame=log, **options(stop=("seq", 4), filters=["x"]))) == want
    assert keys(read_log(spark, frame=log, **options(stop=("seq", 4), stream="B"))) == want[2:]


def test_a_registry_limit_counts_deliveries(spark, three):
    registry = spark.createDataFrame([(">",), ("A.>",)], "filter string")
    assert len(keys(read_log(spark, frame=three, **options(registry=registry, limit=1)))) == 1


def test_registries_hold_for_their_stream_and_time(spark, three):
    entries = [("A", ">", 0, 5), ("A", ">", 0, 5), ("B", "B.1", 6, None), ("C", "nothing", None, None)]
    registry = spark.createDataFrame(entries, "stream string, filter string, from_seq long, to_seq long")
    want = [("A", 1), ("A", 3)] + [("B", i) for i in range(1, 20, 2) if i % 4 == 1 and i >= 6]
    assert keys(read_log(spark, frame=three, **options(registry=registry))) == want
    history = discovery.scan_history(spark, three, registry.where("stream <> 'C'"))
    assert sorted((r.stream, r.stream_seq) for r in history.collect()) == want
    assert keys(read_log(spark, frame=three, **options(registry=registry.limit(0)))) == []


def test_repeated_filters_deliver_once(spark, three):
    twice = spark.createDataFrame([("A.>",), ("A.>",)], "filter string")
    assert len(keys(read_log(spark, frame=three, **options(filters=twice)))) == 10
    scoped = spark.createDataFrame([("A", ">"), ("B", ">")], "stream string, filter string")
    assert len(keys(read_log(spark, frame=three, **options(filters=scoped)))) == 20  # no overlap: other streams


@pytest.mark.parametrize("inline", [0, 100])
def test_malformed_subjects_match_alike_on_either_side_of_the_constant(spark, monkeypatch, inline):
    monkeypatch.setattr(splits, "INLINE_FILTERS", inline)
    subjects = ["a", "a.", "a.b", ".a", "a..b", "a.b.", "", ".", None, "a.b.c", "..", "a. .c"]
    log = log_of(spark, [message(i, s) for i, s in enumerate(subjects)])
    for filter_, want in (("a.*", ["a.b"]), ("a.>", ["a. .c", "a.b", "a.b.c"]), (">", ["a", "a. .c", "a.b", "a.b.c"]),
                          ("*.*.>", ["a. .c", "a.b.c"]), ("a.*.c", ["a. .c", "a.b.c"])):
        got = match_filters(log, FilterSet.of(spark, [filter_])).collect()
        assert sorted(r.subject for r in got) == want, filter_


def test_the_overlap_check_needs_no_pairs(spark):
    rows = [(f"e.{t}.>",) for t in range(300)] + [(f"e.*.{u}",) for u in range(300)]
    filters = spark.createDataFrame(rows, "filter string")
    with pytest.raises(ValueError, match="overlapping"):
        check_no_overlap(spark, filters)
    witnesses = splits.overlap_witnesses(FilterSet.of(spark, filters))
    assert witnesses.count() < 10 and overlapping(FilterSet.of(spark, filters)).count() == 90_000
    assert "Join" not in witnesses._jdf.queryExecution().optimizedPlan().toString()
    check_no_overlap(spark, filters.where("filter like '%>'"))


def test_a_limit_reads_the_first_blocks_only(spark, monkeypatch):
    monkeypatch.setattr(positions, "BLOCK", 10)
    monkeypatch.setattr(store, "BLOCK", 10)
    path = shared_dir(spark, "test")
    append_log(log_of(spark, [message(i, "s.a", b"x") for i in range(1, 200)]), path)
    read = read_log(spark, path, limit=5, metadata=["streamSeq"])
    assert sorted(column(read, "streamSeq")) == [1, 2, 3, 4, 5]
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", read._jdf.queryExecution().executedPlan().toString())
    assert scans and all(re.search(r"seq_block#\d+L? < 1\b", scan) for scan in scans)
    assert len(column(read_log(spark, path, limit=150, metadata=["streamSeq"]), "streamSeq")) == 150
    assert len(column(read_log(spark, path, limit=500, metadata=["streamSeq"]), "streamSeq")) == 199


def test_own_stop_rules_and_acknowledged_reads(spark, three):
    assert keys(read_log(spark, frame=three, **options(stop=lambda log: log.where("stream_seq < 3")))) == [("A", 1), ("B", 1), ("C", 1)]
    read = read_log(spark, frame=three, filters=["A.>"], headers_only=True, metadata=["consumer", "streamSeq"]).first()
    acks = spark.createDataFrame([(f"A > {read.consumer}", 5)], "split_id string, stream_seq long")
    assert len(keys(read_log(spark, frame=three, **options(filters=["A.>"], acks=acks, ack="each")))) == 9
    assert len(keys(read_log(spark, frame=three, **options(filters=["A.>"], acks=acks, ack="all")))) == 7
    with pytest.raises(ValueError):
        read_log(spark, frame=three, **options(filters=["A.>"], ack="all"))


def test_heads_of_many_streams(spark, monkeypatch):
    path = shared_dir(spark, "test")
    append_log(log_of(spark, [message(i, "x", stream=f"s{i % 7}") for i in range(1, 50)]), path)
    want = {r.stream: r["head"] for r in store.stream_heads(spark, path).collect()}
    store.record_heads(spark.createDataFrame([("s1", 8), ("s2", 44)], "stream string, head long"), path)
    for bound in (0, 1000):
        monkeypatch.setattr(store, "MAX_HEAD_SCANS", bound)
        assert {r.stream: r["head"] for r in store.stream_heads(spark, path).collect()} == want
