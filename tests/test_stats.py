from __future__ import annotations

import pytest
from fixtures import log_of, message
from pyspark.sql import Observation

from msglog.operators import stats
from msglog.operators.splits import FilterSet, match_splits, share


@pytest.fixture(scope="module")
def log(spark):
    return log_of(spark, [message(i, f"s.{'ab'[i % 2]}", b"x" * i, msg_id=str(i)) for i in range(1, 10)]
                  + [message(1, "t.a", b"yy", stream="t")])


def test_last_per_subject(spark, log):
    rows = stats.last_per_subject(log, ["msg_id", "data"]).collect()
    assert {r.subject: (r.stream_seq, r.msg_id, len(r.data)) for r in rows} == \
        {"s.a": (8, "8", 8), "s.b": (9, "9", 9), "t.a": (1, None, 2)}
    twice = log_of(spark, [message(5, "a", stream="x"), message(5, "a", stream="y"), message(6, None, stream="x"), message(4, "a", stream="x")])
    got = sorted(((r.stream, r.subject or "", r.stream_seq) for r in stats.last_per_subject(twice, []).collect()))
    assert got == [("x", "", 6), ("x", "a", 5), ("y", "a", 5)]


def test_stream_info(log):
    got = {r.stream: (r.n_messages, r.first_seq, r.last_seq, r.n_subjects) for r in stats.stream_info(log).collect()}
    assert got == {"s": (9, 1, 9, 2), "t": (1, 1, 1, 1)}


def test_flows(spark, log):
    read = match_splits(log, FilterSet.of(spark, ["s.a", "s.b"]), "c")
    row = stats.flow_in(read).first()
    assert (row.n_records, row.n_bytes, row.n_consumers) == (9, 45, 2)
    sizes = {r.stream: (r.n_records, r.min_bytes, r.max_bytes, r.avg_bytes)
             for r in stats.flow_sizes(log, ["stream"]).collect()}
    assert sizes == {"s": (9, 1, 9, 5.0), "t": (1, 2, 2, 2.0)}
    assert {r["filter"]: r.share for r in share(read, ["filter"]).collect()} == {"s.a": 4 / 9, "s.b": 5 / 9}


def test_last_message_and_observation(log):
    assert stats.last_message(log.where("stream = 's'")).first().stream_seq == 9
    seen = Observation("read")
    stats.observed(log, seen).collect()
    assert seen.get == {"n_records": 10, "n_bytes": 47}
