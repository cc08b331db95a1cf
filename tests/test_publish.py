from __future__ import annotations

import random
import re
import string
from datetime import timedelta

import pytest
from fixtures import START, column, log_of, message, people
from pyspark.sql import functions as F

from msglog.functions import headers as H
from msglog.functions import payload as P
from msglog.operators import publish as W
from msglog.operators import stats
from msglog.operators.splits import values
from msglog.sources.log import read_log
from msglog.sources.store import open_log, shared_dir, stream_heads

COLOURS = ["green", "red", "blue"]


@pytest.fixture
def path(spark):
    return shared_dir(spark, "test")


def registry(spark, *entries):
    return values(spark, [{"stream": s, "filter": f} for s, f in entries or [("s", "s.>")]])


def colours(spark):
    return spark.createDataFrame([(c, {"version": ["0", "1"]}) for c in COLOURS],
                                 "colour STRING, headers MAP<STRING, ARRAY<STRING>>")


def texts(df):
    return sorted(column(df.select(P.text(F.col("data")).alias("t")), "t"))


def seqs(df):
    return sorted(column(df, "stream_seq"))


def strings(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return [f"index:{i}-data:{''.join(rng.choices(string.ascii_letters + string.digits, k=rng.randint(50, 99)))}"
            for i in range(n)]


def test_static_subject(spark, path):
    W.publish(W.outgoing(colours(spark), subject="s.foo"), path, registry(spark))
    log = open_log(spark, path)
    assert texts(log) == sorted(f'{{"colour":"{c}"}}' for c in COLOURS)
    assert column(log, "headers") == [{"version": ["0", "1"]}] * 3
    assert set(column(log, "subject")) == {"s.foo"} and seqs(log) == [1, 2, 3]


def test_static_subject_wins_over_the_column(spark):
    rows = colours(spark).withColumn("subject", F.lit("s.other"))
    assert set(column(W.outgoing(rows, subject="s.foo"), "subject")) == {"s.foo"}


def test_subject_per_row(spark, path):
    rows = colours(spark).withColumn("subject", F.concat(F.lit("s."), "colour"))
    W.publish(W.outgoing(rows), path, registry(spark))
    assert sorted(column(open_log(spark, path), "subject")) == ["s.blue", "s.green", "s.red"]


def test_a_subject_is_required(spark):
    with pytest.raises(ValueError, match="no subject"):
        W.outgoing(colours(spark))


def test_source_and_sink_in_one_log(spark, path):
    rows = spark.range(30).select(F.concat(F.lit("s.init."), F.col("id").cast("string")).alias("subject"),
                                  F.element_at(F.array(*map(F.lit, COLOURS)), (F.col("id") % 3 + 1).cast("int")).alias("colour"),
                                  "id")
    W.publish(W.outgoing(rows), path, registry(spark), order_by=["subject"])
    read = read_log(spark, path, format="json", schema="colour STRING, id BIGINT", limit=30, metadata=["subject", "headers"])
    again = read.withColumn("subject", F.regexp_replace("subject", "init.*", F.col("colour")))
    W.publish(W.outgoing(again), path, registry(spark))
    log = open_log(spark, path)
    assert seqs(log) == list(range(1, 61))
    assert log.where(F.col("subject").isin(*[f"s.{c}" for c in COLOURS]) & (F.col("stream_seq") > 30)).count() == 30


def test_writer_message_with_event_time(spark):
    rows = spark.createDataFrame([("foo",)], "v STRING")
    sent = W.outgoing(rows, subject="s.foo", format="string", event_time=F.timestamp_millis(F.lit(10))).first()
    assert bytes(sent.data) == b"foo" and sent.headers == {H.EVENT_TIME_HEADER: ["10"]}


def test_uncaptured_subject_fails_before_anything_is_stored(spark, path):
    good = colours(spark)
    W.publish(W.outgoing(good, subject="s.foo"), path, registry(spark, ("s", "s.*")))
    for bad in ("foo", "s.foo.stuff"):
        with pytest.raises(W.CaptureError, match="no stream captures"):
            W.publish(W.outgoing(good, subject=bad), path, registry(spark, ("s", "s.*")))
    assert seqs(open_log(spark, path)) == [1, 2, 3]


def test_good_messages_of_a_mixed_batch_are_stored_when_not_strict(spark, path):
    rows = spark.createDataFrame([("s.foo",), ("s.foo.stuff",), ("s.bar",)], "subject STRING").withColumn("v", F.lit(1))
    result = W.publish(W.outgoing(rows), path, registry(spark, ("s", "s.*")), strict=False)
    assert result.counts == {"ok": 2, "duplicate": 0, "failed": 1}
    assert sorted(column(open_log(spark, path), "subject")) == ["s.bar", "s.foo"]
    failed = result.messages.where("status = 'failed'").collect()
    assert [(r.subject, r.stream_seq) for r in failed] == [("s.foo.stuff", None)]
    assert {r.status: r.n_records for r in stats.flow_out(result.messages).collect()} == {"ok": 2, "failed": 1}


@pytest.mark.parametrize("subject", ["", "s.", "s..a", "s.*", "s.>", "s.a b", None])
def test_invalid_subjects_are_never_captured(spark, subject):
    rows = spark.createDataFrame([(subject,)], "subject STRING")
    assert column(W.capture(rows, registry(spark)), "stream") == [None]


def test_capture_by_many_streams(spark):
    streams = registry(spark, ("a", "a.>"), ("b", "b.*"), ("b", "c.*.x"), ("deep", "c.y.z.>"), ("one", "lone"))
    rows = spark.createDataFrame([(s,) for s in ["a.1", "a.1.2", "a", "b.1", "b.1.2", "c.q.x", "c.y.z", "c.y.z.1", "lone"]],
                                 "subject STRING")
    got = {r.subject: r.stream for r in W.capture(rows, streams).collect()}
    assert got == {"a.1": "a", "a.1.2": "a", "a": None, "b.1": "b", "b.1.2": None, "c.q.x": "b", "c.y.z": None,
                   "c.y.z.1": "deep", "lone": "one"}


def test_dropped_filters_no_longer_capture(spark):
    history = spark.createDataFrame([("s", "s.a", 1, 9), ("s", "s.b", 1, None)],
                                    "stream STRING, filter STRING, from_seq LONG, to_seq LONG")
    rows = spark.createDataFrame([("s.a",), ("s.b",)], "subject STRING")
    assert {r.subject: r.stream for r in W.capture(rows, history).collect()} == {"s.a": None, "s.b": "s"}


def ids_batch(spark, ids, subject="s.a"):
    rows = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "id STRING, n INT")
    return W.outgoing(rows, subject=subject, columns=["n"], msg_id=F.col("id"), keep=["n"])


def test_duplicates_within_and_across_batches(spark, path):
    first = W.publish(ids_batch(spark, ["a", "b", "a", None, None, "c", "a"]), path, registry(spark), order_by=["n"])
    assert first.counts == {"ok": 5, "duplicate": 2, "failed": 0}
    second = W.publish(ids_batch(spark, ["c", "d", None, "d"]), path, registry(spark), order_by=["n"])
    assert second.counts == {"ok": 2, "duplicate": 2, "failed": 0}
    log = open_log(spark, path)
    assert seqs(log) == list(range(1, 8))
    assert sorted(column(log.where("msg_id IS NOT NULL"), "msg_id")) == ["a", "b", "c", "d"]
    kept = {r.msg_id: bytes(r.data) for r in log.where("stream_seq <= 5 AND msg_id IS NOT NULL").collect()}
    assert kept["a"] == b'{"n":0}'


def test_replayed_batch_stores_nothing(spark, path):
    batch = ids_batch(spark, ["a", "b", "c"])
    W.publish(batch, path, registry(spark))
    assert W.publish(batch, path, registry(spark)).counts == {"ok": 0, "duplicate": 3, "failed": 0}
    assert seqs(open_log(spark, path)) == [1, 2, 3]


def test_the_same_id_in_two_streams_is_no_duplicate(spark, path):
    both = registry(spark, ("s", "s.>"), ("t", "t.>"))
    batch = ids_batch(spark, ["a"]).unionByName(ids_batch(spark, ["a"], "t.a"))
    assert W.publish(batch, path, both).counts["ok"] == 2
    assert sorted((r.stream, r.stream_seq) for r in open_log(spark, path).collect()) == [("s", 1), ("t", 1)]


def test_one_hot_id_keeps_only_its_first(spark):
    rows = log_of(spark, [message(i, "s.a", msg_id="hot" if i % 3 else f"id{i}") for i in range(1, 301)])
    got = {r.stream_seq: r.status for r in W.mark_status(rows, "stream_seq").collect()}
    assert [q for q, s in got.items() if s == "ok"].__len__() == 101 and got[1] == "ok" and got[2] == "duplicate"


def test_dedupe_since_limits_the_look_up(spark, path):
    rows = log_of(spark, [message(i, "s.a", msg_id=str(i)) for i in (1, 2, 3)]).drop("stream", "stream_seq")
    W.publish(rows, path, registry(spark))
    recent = F.lit(START + timedelta(seconds=3))
    assert W.publish(rows, path, registry(spark), dedupe_since=recent).counts == {"ok": 2, "duplicate": 1, "failed": 0}


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_order_of_sequences(spark, path, monkeypatch, broadcast_rows):
    from msglog.operators import splits

    monkeypatch.setattr(splits, "BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(W, "BROADCAST_ROWS", broadcast_rows)
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    W.publish(W.outgoing(rows, subject="s.a", keep=["v"]), path, registry(spark), order_by=["v"])
    log = open_log(spark, path).select("stream_seq", F.get_json_object(P.text(F.col("data")), "$.v").cast("int").alias("v"))
    assert {r.stream_seq: r.v for r in log.collect()} == {i + 1: i for i in range(1000)}


def test_results_keep_their_sequences_after_later_appends(spark, path):
    first = W.publish(ids_batch(spark, ["a", "b"]), path, registry(spark), order_by=["n"])
    W.publish(ids_batch(spark, ["c"]), path, registry(spark))
    again = {r.msg_id: r.stream_seq for r in first.messages.collect()}
    assert again == {"a": 1, "b": 2}


def test_staged_files_can_be_discarded(spark, path):
    from msglog.sources.store import log_exists

    result = W.publish(ids_batch(spark, ["a", "b", "a"]), path, registry(spark))
    assert log_exists(spark, result.stage)
    result.discard()
    assert not log_exists(spark, result.stage)
    assert seqs(open_log(spark, path)) == [1, 2]


def test_heads_see_messages_that_no_head_was_recorded_for(spark, path):
    from msglog.sources.store import append_log

    W.publish(ids_batch(spark, ["a", "b"]), path, registry(spark))
    append_log(log_of(spark, [message(3, "s.a"), message(1, "x.a", stream="x")]), path)  # died before recording
    assert {r.stream: r["head"] for r in stream_heads(spark, path).collect()} == {"s": 3, "x": 1}
    W.publish(ids_batch(spark, ["c"]), path, registry(spark))
    assert max(seqs(open_log(spark, path).where("stream = 's'"))) == 4


def test_head_snapshots_cover_all_streams_and_do_not_pile_up(spark, path, monkeypatch):
    from msglog.sources import store

    monkeypatch.setattr(store, "KEPT_SNAPSHOTS", 2)
    both = registry(spark, ("s", "s.>"), ("t", "t.>"))
    W.publish(ids_batch(spark, [None, None], "t.a"), path, both)
    for _ in range(4):
        W.publish(ids_batch(spark, [None]), path, both)
    kept = store._snapshots(spark, path)
    assert len(kept) == 3
    newest = spark.read.schema("stream STRING, head LONG").parquet(kept[-1])
    assert {r.stream: r["head"] for r in newest.collect()} == {"s": 4, "t": 2}


def test_large_batches_count_what_they_broadcast(spark, path, monkeypatch):
    monkeypatch.setattr(W, "BROADCAST_ROWS", 1)
    for _ in range(2):
        W.publish(ids_batch(spark, ["a", "b", "a", "c", None, None]), path, registry(spark), order_by=["n"])
    assert seqs(open_log(spark, path)) == [1, 2, 3, 4, 5, 6, 7]


def test_many_streams_look_up_heads_at_once(spark, path, monkeypatch):
    from msglog.sources import store

    monkeypatch.setattr(store, "MAX_HEAD_SCANS", 1)
    both = registry(spark, ("s", "s.>"), ("t", "t.>"))
    for _ in range(2):
        batch = ids_batch(spark, [None, None]).unionByName(ids_batch(spark, [None], "t.a"))
        W.publish(batch, path, both)
    assert {r.stream: r["head"] for r in stream_heads(spark, path).collect()} == {"s": 4, "t": 2}


def test_writers_and_token_partitions(spark, path):
    rows = spark.range(200).select("id", F.concat(F.lit("s."), (F.col("id") % 4).cast("string")).alias("subject"))
    W.publish(W.outgoing(rows), path, registry(spark), writers=3, partition_tokens=(1,), max_records_per_file=20)
    log = open_log(spark, path, (1,))
    assert seqs(log) == list(range(1, 201))
    assert sorted({r.token_1 for r in log.select("token_1").distinct().collect()}) == ["0", "1", "2", "3"]
    assert log.select(F.input_file_name()).distinct().count() >= 10


@pytest.mark.parametrize("dies", [False, True])
def test_writers_take_a_large_batch_in_parts(spark, path, monkeypatch, dies):
    monkeypatch.setattr(W, "WRITER_ROWS", 10)
    append, sizes = W.append_log, []

    def counted(rows, *rest):
        if dies and len(sizes) == 2:
            sizes.clear()
            monkeypatch.setattr(W, "append_log", append)
            raise OSError("died")
        sizes.append(rows.count())
        append(rows, *rest)

    monkeypatch.setattr(W, "append_log", counted)
    ids = [str(i // 2 if i % 10 == 1 else i) for i in range(155)]  # some come twice
    rows = ids_batch(spark, ids).unionByName(ids_batch(spark, [None] * 45, "t.x").withColumn("n", F.col("n") + 1000))
    options = dict(order_by=["n"], writers=3, partition_tokens=(1,), batch_id="b-0")
    both = registry(spark, ("s", "s.>"), ("t", "t.>"))
    if dies:
        with pytest.raises(OSError):
            W.publish(rows, path, both, **options)
    W.publish(rows, path, both, **options)
    log = open_log(spark, path, (1,))
    want = list(dict.fromkeys(ids))
    assert [r.msg_id for r in log.where("stream = 's'").orderBy("stream_seq").collect()] == want
    assert seqs(log.where("stream = 's'")) == list(range(1, len(want) + 1)) and seqs(log.where("stream = 't'")) == list(range(1, 46))
    if not dies:
        assert max(sizes) <= 30 and sum(sizes) == len(want) + 45


def test_insert_from_sql(spark, path):
    people(spark).createOrReplaceTempView("people_log")
    W.publish_sql(spark, "SELECT subject, headers, upper(subject) AS loud FROM people_log LIMIT 5", path, registry(spark))
    row = open_log(spark, path).orderBy("stream_seq").first()
    assert bytes(row.data).startswith(b'{"loud":"S.STANDARD.') and row.headers["one"] == ["foo", "bar"]


@pytest.mark.parametrize("n_subjects", [1, 10])
def test_random_strings_arrive(spark, path, n_subjects):
    sent = strings(250, seed=n_subjects)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(sent)], "i INT, v STRING")
    W.publish(W.outgoing(rows, by=W.hash_subject("s", F.col("i"), n_subjects), format="string", columns=["v"]),
              path, registry(spark))
    log = open_log(spark, path)
    assert texts(log) == sorted(sent) and len(set(column(log, "subject"))) == n_subjects


def test_custom_encoder(spark):
    rows = spark.createDataFrame([("abc",)], "v STRING")
    assert bytes(W.outgoing(rows, subject="s.a", format=lambda c: F.unhex(F.lit("00ff")), columns=["v"]).first().data) == b"\x00\xff"


def test_assign_seq_follows_what_is_stored(spark):
    rows = spark.createDataFrame([(30,), (10,), (20,)], "o LONG")
    assert {r.o: r.stream_seq for r in W.assign_seq(rows, "o", 60).collect()} == {10: 61, 20: 62, 30: 63}


class Died(Exception):
    pass


def dying(monkeypatch, when: str, part=None):
    """The next append dies before, in the middle (after ``part`` of it) or after it."""
    plain, left = W.append_log, [1]

    def append(frame, *args):
        if not left:
            return plain(frame, *args)
        left.clear()
        if when == "middle":
            plain(frame.where(part), *args)
        elif when == "after":
            plain(frame, *args)
        raise Died

    monkeypatch.setattr(W, "append_log", append)


def unnamed(spark, n: int, subject: str = "s.a"):
    rows = spark.range(n).select(F.concat(F.lit(f"{subject}."), F.col("id").cast("string")).alias("subject"), "id")
    return W.outgoing(rows, format="string", columns=["subject"], keep=["id"])


@pytest.mark.parametrize("between", [0, 3, 10])
@pytest.mark.parametrize("when,part", [("before", None), ("middle", "stream_seq % 2 = 0"), ("middle", "_addr & 1 = 1"), ("middle", "stream = 't'"), ("after", None)])
def test_a_batch_that_died_is_stored_once_whatever_came_between(spark, path, monkeypatch, when, part, between):
    both = registry(spark, ("s", "s.>"), ("t", "t.>"))
    W.publish(unnamed(spark, 2, "s.first"), path, both, batch_id="q-0")
    batch = unnamed(spark, 5).unionByName(unnamed(spark, 4, "t.a"))
    with monkeypatch.context() as patch:
        dying(patch, when, part)
        with pytest.raises(Died):
            W.publish(batch, path, both, order_by=["subject"], batch_id="q-1")
    if between:
        W.publish(unnamed(spark, between, "s.other"), path, both, batch_id="r-0")
    result = W.publish(batch, path, both, order_by=["subject"], batch_id="q-1")
    stored = {"before": 9, "after": 0}.get(when)
    assert stored is None and 0 < result.counts["ok"] < 9 or result.counts["ok"] == stored
    assert result.messages.count() == result.counts["ok"]
    for _ in range(2):
        log = open_log(spark, path).collect()
        names = [bytes(r.data).decode() for r in log]
        assert sorted(names) == sorted([f"s.first.{i}" for i in range(2)] + [f"s.a.{i}" for i in range(5)] + [f"t.a.{i}" for i in range(4)]
                                       + [f"s.other.{i}" for i in range(between)])
        assert len({(r.stream, r.stream_seq) for r in log}) == len(log)
        assert W.publish(batch, path, both, order_by=["subject"], batch_id="q-1").counts["ok"] == 0
    for stream in "st":
        seen = [r.stream_seq for r in log if r.stream == stream]
        assert between and when == "middle" or sorted(seen) == list(range(1, len(seen) + 1))


def test_a_batch_that_died_while_it_was_finished_is_finished(spark, path, monkeypatch):
    from msglog.sources import side

    def broken(*args):
        raise Died

    rows = ids_batch(spark, ["a", "b"])
    with monkeypatch.context() as patch:
        patch.setattr(side, "extend", broken)
        with pytest.raises(Died):
            W.publish(rows, path, registry(spark), batch_id="q-0")
    assert W.publish(rows, path, registry(spark), batch_id="q-0").counts["ok"] == 0
    assert W.publish(ids_batch(spark, ["b", "c"]), path, registry(spark)).counts == {"ok": 1, "duplicate": 1, "failed": 0}
    assert side.is_covered(spark, path)


def test_a_batch_that_died_while_staging_starts_anew(spark, path, monkeypatch):
    def broken(*args):
        raise Died

    with monkeypatch.context() as patch:
        patch.setattr(W, "marked_spans", broken)
        with pytest.raises(Died):
            W.publish(unnamed(spark, 3), path, registry(spark), batch_id="q-0")
    assert W.publish(unnamed(spark, 3), path, registry(spark), batch_id="q-0").counts["ok"] == 3
    W.forget_batch(spark, path, "q-0")
    assert W.publish(unnamed(spark, 3), path, registry(spark), batch_id="q-0").counts["ok"] == 3  # it is no longer known


def test_a_batch_with_a_duplicate_moves_no_payload(spark, path):
    result = W.publish(ids_batch(spark, ["a", "b", "a", None, "c"]), path, registry(spark), order_by=["n"])
    batch, spans = (spark.read.parquet(f"{result.stage}/{name}") for name in ("batch", "spans"))
    assert spans.where("_bits IS NOT NULL").count() == 1
    for frame in (W._numbered(batch, spans, 1), result.messages):
        plan = frame._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        moved = re.findall(r"\(\d+\) (?:Broadcast)?Exchange\nInput \[\d+\]: \[(.*)\]", plan)
        assert moved and all("data#" not in columns for columns in moved)
    assert [(r.msg_id, r.stream_seq) for r in result.messages.orderBy("n").collect()] == \
        [("a", 1), ("b", 2), ("a", None), (None, 3), ("c", 4)]
