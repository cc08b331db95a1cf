"""Physical plans: what is pushed into scans and what must not appear."""

from __future__ import annotations

import re

import pytest
from fixtures import log_of, message
from local_spark import SF
from pyspark.sql import functions as F

from msglog.functions import subjects as S
from msglog.operators import positions
from msglog.operators.progress import resume
from msglog.operators.splits import FilterSet, match_filters, match_splits, values, with_split
from msglog.plans import inputs
from msglog.sources.adapters import EVENT_SEQ, EVENT_TOKENS, events_log
from msglog.sources.log import read_log
from msglog.sources.store import append_log, open_log, shared_dir


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def pushed(df) -> str:
    return " ".join(re.findall(r"PushedFilters: \[(.*)\]", plan(df)))


@pytest.fixture(scope="module")
def path(spark):
    where = shared_dir(spark, "test")
    append_log(log_of(spark, [message(i, f"s.{'ab'[i % 2]}.{i % 5}", b"{}") for i in range(1, 101)]), where, positions=(1,))
    return where


@pytest.mark.parametrize("condition,want", [
    (lambda: S.matches("s.a.1"), "EqualTo(subject,s.a.1)"),
    (lambda: S.matches("s.a.>"), "StringStartsWith(subject,s.a.)"),
    (lambda: S.matches("s.*.1"), "StringStartsWith(subject,s.)"),
    (lambda: S.matches_any(["s.a.1", "s.b.2"]), "In(subject, [s.a.1,s.b.2])"),
    (lambda: S.matches_any(["s.a.1", "s.b.*"]), "Or(EqualTo(subject,s.a.1),StringStartsWith(subject,s.b.))"),
    (lambda: S.subject_like("s.a.%"), "StringStartsWith(subject,s.a.)"),
    (lambda: S.subject_like("%.1"), "StringEndsWith(subject,.1)"),
    (lambda: S.subject_eq("s.a.1") | S.subject_in(["s.b.1", "s.b.2"]), "Or(EqualTo(subject,s.a.1),In(subject, [s.b.1,s.b.2]))"),
    (lambda: F.lit("s.a.1") == F.col("subject"), "EqualTo(subject,s.a.1)"),
])
def test_subject_predicates_reach_the_scan(spark, path, condition, want):
    assert want in pushed(open_log(spark, path, (1,)).where(condition()))


def test_token_partitions_are_pruned(spark, path):
    log = open_log(spark, path, (1,))
    tokens = {1: ("token_1", "string")}
    got = log.where(S.matches("s.a.>", tokens=tokens))
    assert re.search(r"PartitionFilters: \[.*token_1#\d+ = a", plan(got))
    assert len(got.select("token_1").distinct().collect()) == 1


def test_positions_reach_the_scan(spark, path):
    log = open_log(spark, path, (1,))
    start = positions.start_at(log, ("seq", 40))
    assert "GreaterThanOrEqual(stream_seq,40)" in pushed(start)
    assert re.search(r"PartitionFilters: \[.*seq_block#\d+L? >= 0", plan(start))
    assert "GreaterThanOrEqual(timestamp" in pushed(positions.start_at(log, ("time", 1_704_067_260_000)))
    assert "LessThanOrEqual(stream_seq,7)" in pushed(positions.stop_at(log, ("latest",), snapshot=7))


def test_tables_read_as_logs_push_too(spark):
    log = events_log(spark, SF)
    got = pushed(log.where(S.matches("events.*.7", tokens=EVENT_TOKENS)))
    assert "EqualTo(user_id,7)" in got
    assert "EqualTo(event_type,click)" in pushed(log.where(S.subject_like("events.click.%", tokens=EVENT_TOKENS)))
    assert "GreaterThanOrEqual(event_id,99)" in pushed(positions.start_at(log, ("seq", 100), seq=EVENT_SEQ))
    assert "GreaterThanOrEqual(ts," in pushed(positions.start_at(log, ("time", 1_705_276_800_000)))


def test_unused_columns_are_not_read(spark, path):
    schema = re.search(r"ReadSchema: (.*)", plan(read_log(spark, path, headers_only=True, metadata=["subject"])
                                                 .select("subject"))).group(1)
    assert schema == "struct<subject:string>"


def test_limit_is_below_the_decoder_and_narrow(spark, path):
    text = plan(read_log(spark, path, format="json", schema="a INT", limit=5))
    assert "LessThanOrEqual(stream_seq,ScalarSubquery" in text
    main, subquery = text.split("===== Subqueries =====")
    assert "TakeOrderedAndProject" in subquery and "TakeOrderedAndProject" not in main
    assert set(re.findall(r"ReadSchema: (.*)", subquery)) == {"struct<stream_seq:bigint>"}


def test_subject_predicate_is_below_the_decoder(spark, path):
    read = read_log(spark, path, format="json", schema="a INT", metadata=["subject"])
    assert "StringStartsWith(subject,s.a.)" in pushed(read.where("a = 1 AND subject LIKE 's.a.%'"))


def test_resume_skips_what_all_splits_have_read(spark, path):
    splits = with_split(values(spark, [{"stream": "s", "filter": "s.a.>"}]), "c")
    matched = match_splits(open_log(spark, path, (1,)), FilterSet.of(spark, ["s.a.>"]), "c")
    done = splits.select("split_id", F.lit(90).cast("long").alias("last_seq"), F.lit("active").alias("status"))
    got = resume(matched, done, splits, 1)
    assert "GreaterThan(stream_seq,ScalarSubquery" in pushed(got)
    assert sorted(r.stream_seq for r in got.collect()) == [92, 94, 96, 98, 100]


def test_few_filters_need_no_join_and_many_no_nested_loop(spark):
    assert "Join" not in plan(inputs.split_log(spark, SF))
    many = values(spark, [{"filter": f"events.*.{i}"} for i in range(50)])
    text = plan(match_filters(events_log(spark, SF), FilterSet.of(spark, many)))
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize("options", [{}, {"filters": ["events.click.>"]}, {"filters": ["events.click.>", "events.view.>"]}, {"stream": "events"}])
@pytest.mark.parametrize("rule", [("seq", 50), ("time", 1_705_276_800_000), ("latest",)])
def test_stops_of_a_table_read_as_one_stream_run_no_job_and_compare_no_pairs(spark, rule, options):
    tracker, source = spark.sparkContext.statusTracker(), events_log(spark, SF)
    spark.sparkContext.setJobGroup("stops", "building a read")
    read = read_log(spark, frame=source, stop=rule, seq=EVENT_SEQ, metadata=["streamSeq"], **options)
    jobs = tracker.getJobIdsForGroup("stops")
    spark.sparkContext.setJobGroup("other", "")
    assert not jobs
    text = plan(read)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert read.count() > 0


@pytest.mark.parametrize("column", ["consumerSeq", "pending"])
@pytest.mark.parametrize("filters", [["s.a.>"], ["s.a.>", "s.b.>"]])
def test_positions_in_a_split_move_no_payload(spark, path, column, filters):
    read = read_log(spark, path, filters=filters, partition_tokens=(1,), metadata=["subject", "streamSeq", column])
    text = plan(read)
    moved = re.findall(r"\(\d+\) (?:Broadcast)?Exchange\nInput \[\d+\]: \[(.*)\]", text)
    assert moved and all("data#" not in columns and "headers#" not in columns for columns in moved)
    assert "NestedLoop" not in text
    assert read.count() == 50 * len(filters)
