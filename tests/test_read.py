from __future__ import annotations

import pytest
from fixtures import column, log_of, message, people
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msglog.functions import headers as H
from msglog.functions import metadata as M
from msglog.functions import payload as P
from msglog.operators.splits import values
from msglog.schema import DELIVERIES
from msglog.sources.log import create_log_view, read_log
from msglog.sources.store import append_log, open_log, shared_dir

PERSON = "id BIGINT, name STRING, age INT"
META = dict(format="json", schema=PERSON, metadata=["subject", "headers"], names={"subject": "msg_subject"})


@pytest.fixture(scope="module")
def stored(spark):
    path = shared_dir(spark, "test")
    append_log(people(spark, bad=True), path)
    return path


def ids(df):
    return sorted(column(df, "id"))


def test_select_star_with_a_computed_column(spark):
    rows = read_log(spark, frame=people(spark), **META).withColumn("dob", 2023 - F.col("age")).orderBy("id").collect()
    assert [(r.id, r.name, r.age, r.dob) for r in rows] == [(i, chr(97 + i), 10 * i, 2023 - 10 * i) for i in range(10)]
    assert rows[0].headers == {"one": ["foo", "bar"], "two": ["blue"]} and rows[3].msg_subject == "s.standard.3"
    assert rows[0].asDict().keys() == {"id", "name", "age", "msg_subject", "headers", "dob"}


def test_a_bad_payload_fails_the_read(spark, stored):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_log(spark, stored, **META).collect()


def test_bad_payloads_can_be_null_instead(spark, stored):
    rows = read_log(spark, stored, on_error="null", **META).collect()
    assert len(rows) == 11 and sum(r.id is None for r in rows) == 1


def test_limit_stops_before_the_bad_payload(spark, stored):
    assert ids(read_log(spark, stored, limit=10, **META)) == list(range(10))
    assert ids(read_log(spark, stored, stop=("count", 10), **META)) == list(range(10))


def test_limit_and_stop_both_apply(spark, stored):
    assert ids(read_log(spark, stored, stop=("seq", 4), limit=10, **META)) == [0, 1, 2, 3]
    assert ids(read_log(spark, stored, stop=("seq", 9), limit=2, **META)) == [0, 1]


SUBJECT_QUERIES = [
    " OR ".join(f"msg_subject = 's.standard.{i}'" for i in range(10)),
    "msg_subject IN (" + ", ".join(f"'s.standard.{i}'" for i in range(10)) + ")",
    "msg_subject LIKE 's.standard.%'",
]


@pytest.mark.parametrize("where", SUBJECT_QUERIES)
def test_subject_predicates_in_sql(spark, stored, where):
    create_log_view(spark, "people", stored, **META)
    assert ids(spark.sql(f"SELECT * FROM people WHERE {where}")) == list(range(10))


def test_partly_pushable_predicate(spark, stored):
    create_log_view(spark, "people", stored, **META)
    rows = spark.sql("SELECT * FROM people WHERE id % 2 = 0 AND msg_subject LIKE 's.standard.%'")
    assert ids(rows) == [0, 2, 4, 6, 8]


def test_and_of_two_subjects_is_empty(spark, stored):
    create_log_view(spark, "people", stored, **META)
    where = "msg_subject = 's.standard.1' AND msg_subject = 's.standard.2'"
    assert ids(spark.sql(f"SELECT * FROM people WHERE {where}")) == []


def test_predicates_intersect_with_configured_filters(spark, stored):
    read = read_log(spark, stored, filters=["s.standard.1", "s.standard.2"], **META)
    assert ids(read) == [1, 2]
    assert ids(read.where("msg_subject IN ('s.standard.2', 's.standard.3')")) == [2]


def test_registry_reads_every_message_once(spark, stored):
    registry = values(spark, [{"stream": "s", "filter": "s.standard.*"}, {"stream": "s", "filter": "s.bad"}])
    read = read_log(spark, stored, registry=registry, headers_only=True,
                    metadata=["consumer", "streamSeq", "consumerSeq", "pending"]).orderBy("streamSeq").collect()
    assert [r.consumerSeq for r in read] == [*range(1, 11), 1]
    assert [r.pending for r in read] == [*range(9, -1, -1), 0]
    assert len({r.consumer for r in read}) == 2


def test_unknown_stream_is_empty(spark, stored):
    assert read_log(spark, stored, stream="other", headers_only=True).count() == 0


@pytest.mark.parametrize("options", [
    dict(filters=["s.>", "s.a"]), dict(filters=["s..a"]), dict(filters=[]), dict(metadata=["nope"]),
    dict(metadata=["consumer"]), dict(limit=0), dict(format="json"), dict(on_error="skip"), dict(stream="a.b"),
    dict(start=("seq", -1)), dict(stop=("soon",)),
])
def test_option_checks(spark, stored, options):
    with pytest.raises(ValueError):
        read_log(spark, stored, **options)


def test_filters_and_registry_exclude_each_other(spark, stored):
    with pytest.raises(ValueError, match="not both"):
        read_log(spark, stored, filters=["s.>"], registry=values(spark, [{"filter": "s.>"}]))


def test_stop_rule_decides_on_streaming(spark, stored):
    assert read_log(spark, stored, stop=("never",)).isStreaming
    assert not read_log(spark, stored, stop=("latest",)).isStreaming
    with pytest.raises(ValueError, match="bounded"):
        read_log(spark, stored, stop=("never",), limit=5)


def test_headers_only(spark, stored):
    rows = read_log(spark, stored, headers_only=True, metadata=["streamSeq"]).collect()
    assert {r.streamSeq: r.n_bytes for r in rows}[11] == 1


def test_custom_decoder(spark):
    log = log_of(spark, [message(1, "s.a", b"\x02\x03")])
    assert column(read_log(spark, frame=log, format=lambda data: F.hex(data)), "value") == ["0203"]


def test_split_bad(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    log = log_of(spark, [message(1, "s", b'{"id": 1, "name": "x"}'), message(2, "s", b"\x01"), message(3, "s", b'{"id":"no"}'),
                         (*message(4, "s")[:2], None, *message(4, "s")[3:]), message(5, "s", b'{"id": null}')])
    good, bad = P.split_bad(log, schema)
    assert sorted(column(good, "stream_seq")) == [1, 5] and sorted(column(bad, "stream_seq")) == [2, 3, 4]
    assert good.schema["payload"].dataType.names == ["id", "name"]


def test_formats_round_trip(spark):
    rows = spark.createDataFrame([(1, "a,b", None), (2, None, 1.5)], "id INT, name STRING, v DOUBLE")
    for fmt, schema in (("json", "id INT, name STRING, v DOUBLE"), ("csv", "id INT, name STRING, v DOUBLE")):
        back = rows.select(P.encoded(fmt, ["id", "name", "v"]).alias("data")) \
            .select(P.parsed(F.col("data"), fmt, schema).alias("p")).select("p.*")
        assert sorted(map(tuple, back.collect())) == [(1, "a,b", None), (2, None, 1.5)]
    with pytest.raises(ValueError, match="one column"):
        P.encoded("string", ["id", "name"])
    with pytest.raises(ValueError, match="unknown payload format"):
        P.parsed(F.lit(b""), "xml", "a INT")


def test_headers(spark):
    rows = spark.createDataFrame([({"b": ["2", "1"], "none": [], "null": None},), (None,)],
                                 "headers MAP<STRING, ARRAY<STRING>>")
    written = column(rows.select(H.writable(F.col("headers")).alias("h")), "h")
    assert written == [{"b": ["2", "1"]}, {}]
    stamped = rows.select(H.with_event_time(H.with_event_time(F.col("headers"), F.lit("2024-01-01").cast("timestamp")),
                                            F.timestamp_millis(F.lit(10))).alias("h"))
    assert [h[H.EVENT_TIME_HEADER] for h in column(stamped, "h")] == [["10"], ["10"]]
    assert column(rows.select(H.first_value(F.col("headers"), "b").alias("v")), "v") == ["2", None]


def test_metadata_of_an_unsplit_read(spark):
    log = people(spark)
    with pytest.raises(ValueError, match="not available"):
        M.project(log, [], ["delivered"])
    assert M.project(log.withColumn("headers", F.lit(None).cast(log.schema["headers"].dataType)), [], ["headers"]) \
        .first().headers == {}


def test_delivered_counts_past_attempts(spark):
    log = people(spark)
    assert set(column(read_log(spark, frame=log, headers_only=True, metadata=["delivered"]), "delivered")) == {1}
    options = dict(frame=log, filters=["s.standard.*"], headers_only=True)
    split = read_log(spark, metadata=["consumer"], **options).first().consumer
    past = spark.createDataFrame([(f"s > {split}", 3, 1, None), (f"s > {split}", 3, 2, None), ("other", 4, 1, None)],
                                 DELIVERIES)
    read = read_log(spark, metadata=["streamSeq", "delivered"], deliveries=past, **options).collect()
    assert {r.streamSeq: r.delivered for r in read} == {i: 3 if i == 3 else 1 for i in range(1, 11)}


def test_stored_by_token(spark):
    path = shared_dir(spark, "test")
    append_log(people(spark), path, positions=(1,))
    assert open_log(spark, path, (1,)).where("token_1 = 'standard'").count() == 10
    read = read_log(spark, path, partition_tokens=(1,), filters=["s.standard.4"], **META)
    assert ids(read) == [4]
