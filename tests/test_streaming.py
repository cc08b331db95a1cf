from __future__ import annotations

import random
import string
from datetime import datetime, timedelta

import pytest
from fixtures import START, column, log_of, message
from pyspark.sql import functions as F

from msglog.operators import publish as W
from msglog.operators.splits import values
from msglog.operators.stats import observed
from msglog.sources.log import read_log
from msglog.sources.store import append_log, open_log, open_stream, shared_dir
from msglog.streaming import flows
from msglog.streaming.redelivery import redeliver_stream


@pytest.fixture
def path(spark):
    return shared_dir(spark, "test")


def registry(spark):
    return values(spark, [{"stream": "s", "filter": "s.>"}])


def contents(split: int, n: int = 500) -> list[str]:
    rng = random.Random(split)
    return [f"split:{split}-index:{i}-content:{''.join(rng.choices(string.ascii_letters, k=rng.randint(1, 20)))}"
            for i in range(n)]


def append(spark, path, first, texts, subject):
    append_log(log_of(spark, [message(first + i, subject, t.encode(), msg_id=str(first + i))
                              for i, t in enumerate(texts)]).coalesce(1), path)


def test_streamed_content_equals_the_batch_read(spark, path):
    sent = []
    for split in range(4):
        texts = contents(split)
        append(spark, path, len(sent) + 1, texts, f"s.{split}")
        sent += texts
    options = dict(filters=[f"s.{i}" for i in range(4)], metadata=["streamSeq", "consumer"])
    stream = read_log(spark, path, stop=("never",), max_files=1, **options)
    query = flows.drain(stream, f"{path}-out", f"{path}-checkpoint")
    assert len([p for p in query.recentProgress if p.numInputRows]) == 4
    drained = spark.read.parquet(f"{path}-out")
    assert sorted(column(drained, "value")) == sorted(sent)
    assert sorted(map(tuple, drained.select("value", "streamSeq", "consumer").collect())) == \
        sorted(map(tuple, read_log(spark, path, **options).select("value", "streamSeq", "consumer").collect()))


def test_a_restart_neither_loses_nor_repeats(spark, path):
    def run():
        flows.drain(read_log(spark, path, stop=("never",), metadata=["streamSeq"]), f"{path}-out", f"{path}-checkpoint")
        return sorted(column(spark.read.parquet(f"{path}-out"), "streamSeq"))

    append(spark, path, 1, ["x"] * 50, "s.a")
    assert run() == list(range(1, 51))
    append(spark, path, 51, ["x"] * 10, "s.a")
    assert run() == list(range(1, 61))
    assert run() == list(range(1, 61))


def test_start_latest_on_a_stream(spark, path):
    append(spark, path, 1, ["x"] * 5, "s.a")
    with pytest.raises(ValueError, match="snapshot"):
        read_log(spark, frame=open_stream(spark, path), start=("latest",), stop=("never",))
    for n, options in enumerate(({}, {"stream": "s"}, {"stream": "new"})):
        live = read_log(spark, path, start=("latest",), stop=("never",), metadata=["streamSeq"], **options)
        append(spark, path, 6 + n, ["y"], "s.a")
        flows.drain(live, f"{path}-live{n}", f"{path}-live{n}-checkpoint")
        assert column(spark.read.schema(live.schema).parquet(f"{path}-live{n}"), "streamSeq") == ([6 + n] if n < 2 else [])
    stream = read_log(spark, path, start=("latest",), snapshot=3, stop=("never",), metadata=["streamSeq"])
    flows.drain(stream, f"{path}-out", f"{path}-checkpoint")
    assert sorted(column(spark.read.parquet(f"{path}-out"), "streamSeq")) == [4, 5, 6, 7, 8]


def test_a_poll_is_bounded_one_way_only(spark, path):
    append(spark, path, 1, ["x"], "s.a")
    with pytest.raises(ValueError):
        open_stream(spark, path, max_files=1, max_bytes=1)
    assert open_stream(spark, path, max_bytes=10_000).isStreaming


def test_streaming_sink_is_dense_and_absorbs_replays(spark, path):
    append(spark, path, 1, contents(1, 40), "s.a")
    append(spark, path, 41, contents(2, 40), "s.b")
    target = f"{path}-target"

    def run(checkpoint):
        flows.publish_stream(open_stream(spark, path, max_files=1).drop("stream", "stream_seq"), target, registry,
                             checkpoint, partition_tokens=(1,)).awaitTermination()
        return sorted(column(open_log(spark, target), "stream_seq"))

    assert run(f"{path}-c1") == list(range(1, 81))
    append(spark, path, 81, contents(3, 5), "s.c")
    assert run(f"{path}-c1") == list(range(1, 86))
    assert run(f"{path}-c2") == list(range(1, 86))  # a lost checkpoint replays everything


def test_registry_is_read_again_for_every_batch(spark, path):
    append(spark, path, 1, ["x"] * 3, "s.a")
    append(spark, path, 4, ["x"] * 3, "s.b")
    seen = []

    def growing(s):
        seen.append(1)
        names = ["s.a"] if len(seen) == 1 else ["s.a", "s.b"]
        return values(s, [{"stream": "s", "filter": n} for n in names])

    flows.publish_stream(open_stream(spark, path, max_files=1).drop("stream", "stream_seq"), f"{path}-target", growing,
                         f"{path}-checkpoint", strict=False).awaitTermination()
    assert len(seen) == 2 and open_log(spark, f"{path}-target").count() in (3, 6)


def test_consume_follows_added_and_withdrawn_filters(spark, path):
    for i in range(3):
        append_log(log_of(spark, [message(3 * i + j, f"s.{c}") for j, c in enumerate("abc", start=1)]).coalesce(1), path)
    names = iter([["s.a"], ["s.a", "s.b"], ["s.b"]])
    seen = []

    def handle(batch, epoch):
        seen.append((epoch, sorted((r["filter"], r.split_id.startswith("s > job-")) for r in batch.collect())))

    flows.consume(open_stream(spark, path, max_files=1), handle, f"{path}-checkpoint",
                  lambda s: values(s, [{"filter": n} for n in next(names)]), prefix="job").awaitTermination()
    assert seen == [(0, [("s.a", True)]), (1, [("s.a", True), ("s.b", True)]), (2, [("s.b", True)])]


def test_uncaptured_subject_fails_the_stream(spark, path):
    append(spark, path, 1, ["x"], "s.a")
    query = flows.publish_stream(open_stream(spark, path).drop("stream", "stream_seq"), f"{path}-target",
                                 lambda s: values(s, [{"stream": "t", "filter": "t.>"}]), f"{path}-checkpoint")
    with pytest.raises(Exception, match="no stream captures"):
        query.awaitTermination()


def test_dedupe_with_unbounded_state(spark, path):
    append(spark, path, 1, ["x"] * 5, "s.a")
    append_log(log_of(spark, [message(i, "s.a", msg_id=str(i - 5)) for i in range(6, 11)]), path)
    flows.drain(flows.dedupe_stream(open_stream(spark, path)).select("msg_id"), f"{path}-out", f"{path}-checkpoint")
    assert sorted(column(spark.read.parquet(f"{path}-out"), "msg_id")) == list("12345")


def test_windowed_dedupe_drops_late_messages_and_the_exact_one_does_not(spark, path):
    late = [message(i, "s.a", msg_id=str(i), at=START + timedelta(days=-i)) for i in (1, 2, 3)]
    for row in late:
        append_log(log_of(spark, [row]).coalesce(1), path)
    got = {}
    for delay in ("1 hour", None):
        out = f"{path}-{bool(delay)}"
        flows.drain(flows.dedupe_stream(open_stream(spark, path, max_files=1), delay).select("msg_id"), out, f"{out}-c")
        got[delay] = sorted(column(spark.read.parquet(out), "msg_id"))
    assert "3" not in got["1 hour"] and got[None] == ["1", "2", "3"]


def test_watermark_closes_windows(spark, path):
    append_log(log_of(spark, [message(i, "s.a", at=START + timedelta(hours=i)) for i in range(1, 60)]), path)
    stream = read_log(spark, path, stop=("never",), watermark="1 hour", metadata=["streamSeq"])
    daily = stream.groupBy(F.window("event_time", "1 day").alias("w")).count().select(F.dayofmonth("w.start").alias("d"), "count")
    flows.drain(daily, f"{path}-out", f"{path}-checkpoint")
    assert sorted(map(tuple, spark.read.parquet(f"{path}-out").select("d", "count").collect())) == [(1, 23), (2, 24)]


def test_observed_metrics_of_a_stream(spark, path):
    append(spark, path, 1, ["abc"] * 7, "s.a")
    query = flows.drain(observed(open_stream(spark, path), "read").select("subject"), f"{path}-out", f"{path}-checkpoint")
    row = [p.observedMetrics["read"] for p in query.recentProgress if p.numInputRows][0]
    assert (row.n_records, row.n_bytes) == (7, 21)


def test_dedupe_stream_then_publish(spark, path):
    append(spark, path, 1, ["x"] * 4, "s.a")
    messages = flows.dedupe_stream(open_stream(spark, path)).drop("stream", "stream_seq")
    flows.publish_stream(messages, f"{path}-t", registry, f"{path}-c", dedupe=False).awaitTermination()
    assert sorted(column(open_log(spark, f"{path}-t"), "stream_seq")) == [1, 2, 3, 4]
    assert W.OK == "ok"


def test_a_replayed_batch_without_ids_is_stored_once(spark, path):
    batch = log_of(spark, [message(i, "s.a", b"x") for i in range(1, 4)]).drop("stream", "stream_seq")
    for epoch, total in (("q-0", 3), ("q-0", 3), ("q-1", 6), ("q-0", 6), ("q-1", 6)):
        result = W.publish(batch, path, registry(spark), batch_id=epoch)
        assert open_log(spark, path).count() == total and set(result.counts) == {"ok", "duplicate", "failed"}
        assert result.messages.columns is not None
        result.discard()
    assert sorted(column(open_log(spark, path), "stream_seq")) == list(range(1, 7))


def test_a_late_filter_is_caught_up_once(spark, path):
    known, got = ["s.a"], []

    def filters(session):
        return session.createDataFrame([("s", f) for f in known], "stream string, filter string")

    def handle(batch, epoch):
        got.extend((r.subject, r.stream_seq) for r in batch.select("subject", "stream_seq").collect())

    def run():
        flows.consume(open_stream(spark, path), handle, f"{path}-checkpoint", filters,
                      stored=lambda session: open_log(session, path)).awaitTermination()

    append(spark, path, 1, ["x"] * 2, "s.a")
    append(spark, path, 3, ["x"] * 2, "s.b")
    run()
    assert sorted(got) == [("s.a", 1), ("s.a", 2)]
    known.append("s.b")
    append(spark, path, 5, ["x"], "s.b")
    run()
    assert sorted(got) == [("s.a", 1), ("s.a", 2), ("s.b", 3), ("s.b", 4), ("s.b", 5)]
    known.clear()  # no filters deliver nothing
    append(spark, path, 6, ["x"], "s.b")
    run()
    assert len(got) == 5


def test_the_watermark_of_a_union_is_that_of_its_slower_filter(spark, path):
    rows = [message(i, "s.fast", b"", at=datetime(2024, 1, 1, i)) for i in range(1, 13)]
    rows += [message(20 + i, "s.slow", b"", at=datetime(2024, 1, 1, i)) for i in range(1, 4)]
    append_log(log_of(spark, rows), path)
    merged = flows.split_watermarks(lambda: open_stream(spark, path), ["s.fast", "s.slow"], "10 minutes")
    hourly = merged.groupBy(F.window("event_time", "1 hour").alias("w")).agg(F.count("*").alias("n")).select("w.end", "n")
    flows.drain(hourly, f"{path}-hours", f"{path}-hours-checkpoint")
    closed = spark.read.schema(hourly.schema).parquet(f"{path}-hours")
    assert closed.agg(F.max("end")).first()[0] <= datetime(2024, 1, 1, 3) and closed.count() > 0


def test_fifty_watermarks_are_one_scan(spark, path):
    rows = [message(i, f"s.{i % 50}", at=START + timedelta(hours=i if i % 50 else i // 2)) for i in range(1, 401)]
    append_log(log_of(spark, rows), path)
    names = [f"s.{i}" for i in range(50)]
    merged = flows.split_watermarks(open_stream(spark, path), names, "1 hour")
    daily = merged.groupBy(F.window("event_time", "1 day").alias("w")).agg(F.count("*").alias("n")).select("w.end", "n")
    query = flows.drain(daily, f"{path}-days", f"{path}-days-checkpoint")
    assert len([p for p in query.recentProgress if p.numInputRows]) == 1
    assert sum(p.numInputRows for p in query.recentProgress) == 400  # each message is read once
    assert query.recentProgress[0].sources is not None and len(query.recentProgress[0].sources) == 1
    closed = [r.end for r in spark.read.schema(daily.schema).parquet(f"{path}-days").collect()]
    assert max(closed) <= START + timedelta(hours=199) and len(closed) >= 7  # s.0 is half as far as the others


def test_a_filter_without_messages_holds_the_watermark_back(spark, path):
    append_log(log_of(spark, [message(i, "s.a", at=START + timedelta(hours=i)) for i in range(1, 60)]), path)
    merged = flows.split_watermarks(open_stream(spark, path), ["s.a", "s.b"], "1 hour")
    daily = merged.groupBy(F.window("event_time", "1 day").alias("w")).agg(F.count("*").alias("n")).select("w.end", "n")
    flows.drain(daily, f"{path}-days", f"{path}-days-checkpoint")
    assert spark.read.schema(daily.schema).parquet(f"{path}-days").count() == 0


class Broken(Exception):
    pass


def test_a_query_that_dies_resumes_each_split_and_a_paused_one_loses_nothing(spark, path):
    from msglog.sources.store import list_folder

    status, got, broken = {"s.a": "active", "s.b": "active"}, {}, []

    def filters(session):
        return session.createDataFrame([("s", f, x) for f, x in status.items()], "stream string, filter string, status string")

    def handle(batch, epoch):
        got[epoch] = sorted((r.subject, r.stream_seq) for r in batch.select("subject", "stream_seq").collect())
        if broken:
            broken.clear()
            raise Broken

    def run(first):
        append_log(log_of(spark, [message(i, f"s.{'ab'[i % 2]}") for i in range(first, first + 4)]).coalesce(1), path)
        query = flows.consume(open_stream(spark, path), handle, f"{path}-checkpoint", filters, stored=lambda s: open_log(s, path))
        try:
            query.awaitTermination()
        except Exception:
            flows.consume(open_stream(spark, path), handle, f"{path}-checkpoint", filters,
                          stored=lambda s: open_log(s, path)).awaitTermination()
        return {r.split_id.split("consumer-")[1]: (r.last_seq, r.status) for r in flows.consumed(spark, f"{path}-checkpoint").collect()}

    run(1)
    assert got[0] == [("s.a", 2), ("s.a", 4), ("s.b", 1), ("s.b", 3)]
    status["s.b"] = "paused"
    broken.append(1)
    state = run(5)
    assert got[1] == [("s.a", 6), ("s.a", 8)]
    assert sorted(state.values()) == [(4, "paused"), (8, "active")]
    del status["s.a"]  # withdrawn
    run(9)
    assert got[2] == []
    status |= {"s.a": "active", "s.b": "active"}
    state = run(13)
    assert got[3] == [("s.a", i) for i in (10, 12, 14, 16)] + [("s.b", i) for i in (5, 7, 9, 11, 13, 15)]
    assert sorted(state.values()) == [(16, "active")] * 2
    assert len(list_folder(spark, f"{path}-checkpoint-state")) <= flows.KEPT_STATES + 1


@pytest.mark.parametrize("catch_up,want", [(True, [1, 2, 3, 4, 5, 6]), (False, [1, 2, 5, 6])])
def test_a_filter_that_comes_back_catches_up_or_skips(spark, path, catch_up, want):
    known, got = ["b.>"], []

    def run(first):
        append_log(log_of(spark, [message(i, "b.x") for i in range(first, first + 2)]).coalesce(1), path)
        flows.consume(open_stream(spark, path), lambda batch, _: got.extend(r.stream_seq for r in batch.collect()), f"{path}-checkpoint",
                      lambda s: s.createDataFrame([("s", f) for f in known], "stream string, filter string"),
                      stored=lambda s: open_log(s, path), catch_up=catch_up).awaitTermination()

    run(1)
    known.clear()
    run(3)
    known.append("b.>")
    run(5)
    assert sorted(got) == want


def test_outcomes_of_a_publishing_query_are_kept(spark, path, monkeypatch):
    monkeypatch.setattr(flows, "MERGED_EPOCHS", 2)
    for i in range(5):
        append(spark, path, 2 * i + 1, ["xy", "z"], "s.a")
    doubled = open_stream(spark, path, max_files=1).drop("stream", "stream_seq").withColumn("msg_id", F.expr("if(msg_id = '4', '3', msg_id)"))
    flows.publish_stream(doubled, f"{path}-t", registry, f"{path}-c", metrics=f"{path}-m").awaitTermination()
    rows = flows.flow_metrics(spark, f"{path}-m")
    assert {r.status: (r.n, r.b) for r in rows.groupBy("status").agg(F.sum("n_records").alias("n"), F.sum("n_bytes").alias("b")).collect()} \
        == {"ok": (9, 14), "duplicate": (1, 1)}
    assert rows.select("epoch").distinct().count() == 5


def test_unacknowledged_messages_come_again_until_their_attempts_are_used_up(spark, path):
    at = lambda minutes: START + timedelta(minutes=minutes)
    d_schema, a_schema = "split_id STRING, stream_seq LONG, attempt INT, delivered_at TIMESTAMP", "split_id STRING, stream_seq LONG, acked_at TIMESTAMP"

    def add(deliveries, acks):
        spark.createDataFrame(deliveries, d_schema).coalesce(1).write.mode("append").parquet(f"{path}-d")
        spark.createDataFrame(acks, a_schema).coalesce(1).write.mode("append").parquet(f"{path}-a")

    def run():
        due = redeliver_stream(spark.readStream.schema(d_schema).parquet(f"{path}-d"), spark.readStream.schema(a_schema).parquet(f"{path}-a"),
                               "10 minutes", max_deliver=3)
        flows.drain(due, f"{path}-out", f"{path}-c")
        rows = spark.read.schema(due.schema).parquet(f"{path}-out").collect()
        return sorted((r.split_id, r.stream_seq, r.attempt, (r.due_at - START).seconds // 60) for r in rows)

    add([("x", 1, 1, at(0)), ("x", 2, 1, at(0)), ("y", 1, 1, at(0)), ("x", 3, 3, at(0)), ("t", -1, 0, at(5))], [("x", 1, at(1))])
    assert run() == []
    add([("t", -1, 0, at(12))], [])  # time passes, with a restart in between
    first = [("x", 2, 2, 10), ("y", 1, 2, 10)]
    assert run() == first
    add([("t", -1, 0, at(15))], [("y", 1, at(14))])
    assert run() == first
    add([("t", -1, 0, at(60))], [])
    assert run() == sorted([*first, ("x", 2, 3, 20)])
    add([("t", -1, 0, at(600))], [])
    assert run() == sorted([*first, ("x", 2, 3, 20)])


def test_messages_of_a_span_share_a_state(spark, path):
    d_schema, a_schema = "split_id STRING, stream_seq LONG, attempt INT, delivered_at TIMESTAMP", "split_id STRING, stream_seq LONG, acked_at TIMESTAMP"
    seqs = [-4097, -4096, -1, 0, *range(4000, 4300), 8191, 8192]  # ends of spans, and two spans with many messages
    acked = [s for s in seqs if s % 2]
    told = [("x", s, 1, START) for s in seqs] + [("y", 4096, 2, START), ("t", -1, 0, START + timedelta(minutes=10))]
    spark.createDataFrame(told, d_schema).coalesce(1).write.parquet(f"{path}-d")
    spark.createDataFrame([("x", s, START) for s in acked], a_schema).coalesce(1).write.parquet(f"{path}-a")
    due = redeliver_stream(spark.readStream.schema(d_schema).parquet(f"{path}-d"), spark.readStream.schema(a_schema).parquet(f"{path}-a"),
                           "10 minutes", max_deliver=2)
    query = flows.drain(due, f"{path}-out", f"{path}-c")
    rows = spark.read.schema(due.schema).parquet(f"{path}-out").collect()
    assert sorted(map(tuple, rows)) == sorted(("x", s, 2, START + timedelta(minutes=10)) for s in seqs if s not in acked)
    states = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert 0 < max(states) < len(seqs) / 10
