from __future__ import annotations

from datetime import timedelta

import pytest
from fixtures import START, column, log_of, message
from pyspark.sql import functions as F

from msglog.operators import progress as G
from msglog.operators.splits import FilterSet, match_splits, values, with_split
from msglog.schema import ACKS, DELIVERIES, PROGRESS


def delivered(spark, rows):
    return spark.createDataFrame([(s, q, a, START + timedelta(seconds=t)) for s, q, a, t in rows], DELIVERIES)


def acked(spark, rows):
    return spark.createDataFrame([(s, q, START) for s, q in rows], ACKS)


def progress(spark, rows):
    return spark.createDataFrame([(*r, None) if len(r) == 3 else r for r in rows], PROGRESS)


def keys(df):
    return sorted((r.split_id, r.stream_seq) for r in df.collect())


@pytest.mark.parametrize("all_at_once", [True, False])
def test_ack_floor(spark, all_at_once):
    sent = delivered(spark, [("x", i, 1, 0) for i in range(1, 27)])
    acks = acked(spark, [("x", i) for i in range(1, 26)])
    row = G.floors(sent, acks, 1).first()
    assert (row.ack_floor, row.delivered_floor) == (25, 26)
    ack = "all" if all_at_once else "each"
    last = acked(spark, [("x", 25)]) if all_at_once else acks
    assert keys(G.pending(sent, last, ack, 1)) == [("x", 26)]


def test_floor_stops_at_the_first_gap(spark):
    sent = delivered(spark, [("x", i, 1, 0) for i in (3, 5, 8, 9)] + [("y", 4, 1, 0)] + [("z", 2, 1, 0)])
    rows = {r.split_id: (r.ack_floor, r.delivered_floor)
            for r in G.floors(sent, acked(spark, [("x", 3), ("x", 5), ("x", 9), ("z", 2)])).collect()}
    assert rows == {"x": (5, 9), "y": (0, 4), "z": (2, 2)}


def test_pending_until_the_last_checkpoint(spark):
    sent = delivered(spark, [(s, i, 1, 0) for s in "xy" for i in (1, 2, 3)])
    nothing = acked(spark, [])
    assert {r.split_id: r.ack_pending for r in G.pending_count(sent, nothing).collect()} == {"x": 3, "y": 3}
    everything = acked(spark, [(s, i) for s in "xy" for i in (1, 2, 3)])
    assert {r.split_id: r.ack_pending for r in G.pending_count(sent, everything).collect()} == {"x": 0, "y": 0}


def test_policies(spark):
    sent = delivered(spark, [("x", 1, 1, 0), ("x", 2, 1, 0), ("x", 3, 1, 0), ("y", 1, 1, 0)])
    acks = acked(spark, [("x", 2)])
    assert keys(G.pending(sent, acks, "each")) == [("x", 1), ("x", 3), ("y", 1)]
    assert keys(G.pending(sent, acks, "all")) == [("x", 3), ("y", 1)]
    assert keys(G.pending(sent, acks, "none")) == []
    assert keys(G.acked_cumulative(sent, acks)) == [("x", 1), ("x", 2)]
    assert keys(G.acked_explicit(sent, acks)) == [("x", 2)]
    assert G.acked_none(sent).count() == 4
    with pytest.raises(ValueError):
        G.pending(sent, acks, "some")


def test_redelivery(spark):
    sent = delivered(spark, [("x", 1, 1, 0), ("x", 2, 1, 0), ("x", 2, 2, 50), ("x", 3, 1, 0), ("x", 3, 2, 10),
                             ("x", 4, 1, 90), ("x", 5, 1, 0)])
    now = F.lit(START + timedelta(seconds=100))
    due = G.redeliver(sent, acked(spark, [("x", 5)]), now, "30 SECONDS", max_deliver=2)
    assert [(r.stream_seq, r.attempt) for r in due.collect()] == [(1, 2)]
    unlimited = G.redeliver(sent, acked(spark, [("x", 5)]), now, "30 SECONDS")
    assert sorted((r.stream_seq, r.attempt) for r in unlimited.collect()) == [(1, 2), (2, 3), (3, 3)]
    assert {r.stream_seq: r.delivered for r in G.delivered_count(sent).collect()}[3] == 2


@pytest.fixture(scope="module")
def read(spark):
    log = log_of(spark, [message(i, "s.a" if i % 2 else "s.b") for i in range(1, 13)])
    return match_splits(log, FilterSet.of(spark, ["s.a", "s.b"]), "c")


@pytest.fixture(scope="module")
def names(spark):
    splits = with_split(values(spark, [{"stream": "s", "filter": f} for f in ("s.a", "s.b")]), "c")
    return splits, {r["filter"]: r.split_id for r in splits.collect()}


@pytest.mark.parametrize("pruned", [True, False])
def test_resume_and_pause(spark, read, names, pruned):
    splits, name = names
    a, b = name["s.a"], name["s.b"]
    args = (splits,) if pruned else ()
    both = progress(spark, [(a, 5, "active"), (b, 8, "active")])
    assert sorted(column(G.resume(read, both, *args), "stream_seq")) == [7, 9, 10, 11, 12]
    fresh = progress(spark, [(a, 5, "active")])
    assert sorted(column(G.resume(read, fresh, *args), "stream_seq")) == [2, 4, 6, 7, 8, 9, 10, 11, 12]
    paused = G.set_status(both, pause=(a, b))
    assert G.resume(read, paused, *args).count() == 0
    resumed = G.set_status(paused, resume=(a,))
    assert sorted(column(G.resume(read, resumed, *args), "stream_seq")) == [7, 9, 11]
    assert sorted(column(G.resume(read, progress(spark, []), *args), "stream_seq")) == list(range(1, 13))


def test_progress_after_a_batch(spark, read, names):
    _, name = names
    a, b = name["s.a"], name["s.b"]
    old = progress(spark, [(a, 5, "active"), ("gone", 3, "paused")])
    new = {r.split_id: (r.last_seq, r.status) for r in G.update_progress(old, read.where("stream_seq <= 8")).collect()}
    assert new == {a: (7, "active"), b: (8, "active"), "gone": (3, "paused")}
    unchanged = G.update_progress(old, read.where("false"))
    assert {r.split_id: r.last_seq for r in unchanged.collect()} == {a: 5, "gone": 3}


def test_a_completed_epoch_covers_earlier_ones(spark):
    history = progress(spark, [("x", 3, None, 1), ("x", 6, None, 2), ("x", 9, None, 3), ("y", 2, None, 2)])
    assert {r.split_id: r.last_seq for r in G.completed_progress(history, 2).collect()} == {"x": 6, "y": 2}
    assert G.completed_progress(history, 0).count() == 0
