from __future__ import annotations

import random

import pytest
from fixtures import column, log_of, message
from pyspark.sql import functions as F

from msglog.functions import subjects
from msglog.operators import discovery
from msglog.operators.splits import FilterSet, overlap_classes, overlaps_of, values


def filters(spark, *names):
    return values(spark, [{"stream": "s", "filter": n} for n in names])


def test_added_revoked(spark):
    old = filters(spark, "red", "green", "blue", "yellow")
    new = filters(spark, "green", "blue", "orange")
    assert column(discovery.added(old, new), "filter") == ["orange"]
    assert sorted(column(discovery.revoked(old, new), "filter")) == ["red", "yellow"]


def test_registry_history_bounds_what_is_read(spark):
    empty = spark.createDataFrame([], "stream STRING, filter STRING, from_seq LONG, to_seq LONG")
    first = discovery.update_registry(empty, filters(spark, "s.red", "s.green"), 1)
    second = discovery.update_registry(first, filters(spark, "s.green", "s.orange"), 5)
    again = discovery.update_registry(second, filters(spark, "s.green", "s.orange", "s.red"), 9)
    got = {(r["filter"], r.from_seq, r.to_seq) for r in again.collect()}
    assert got == {("s.red", 1, 5), ("s.red", 9, None), ("s.green", 1, None), ("s.orange", 5, None)}
    log = log_of(spark, [message(i, s) for i, s in enumerate(["s.red", "s.orange", "s.green"] * 4, start=1)])
    read = {(r.stream_seq, r["filter"]) for r in discovery.scan_history(spark, log, again).collect()}
    assert read == {(1, "s.red"), (4, "s.red"), (10, "s.red"), (3, "s.green"), (6, "s.green"), (9, "s.green"),
                    (12, "s.green"), (5, "s.orange"), (8, "s.orange"), (11, "s.orange")}


def test_discover_filters(spark):
    log = log_of(spark, [message(1, "a.b.c"), message(2, "a.b.d.e"), message(3, "a.b"), message(4, "a")])
    assert sorted(column(discovery.discover_filters(log, 2), "filter")) == ["a", "a.b", "a.b.>"]


def test_unread(spark):
    splits = values(spark, [{"split_id": "x"}, {"split_id": "y"}])
    assert column(discovery.unread(splits, values(spark, [{"split_id": "x"}])), "split_id") == ["y"]


@pytest.mark.parametrize("seed", range(4))
def test_overlap_classes_agree_with_all_pairs(spark, seed):
    rng = random.Random(seed)
    filters = sorted({".".join(rng.choice(["a", "b", "c", "*"]) for _ in range(rng.randint(1, 3))) + rng.choice(["", "", ".>"]) for _ in range(25)})
    pairs = [(x, y) for x in filters for y in filters if x != y and subjects.collide(x, y)]
    label = {f: f for f in filters}
    for x, y in pairs * 2:
        low, high = sorted((label[x], label[y]))
        label = {f: low if c == high else c for f, c in label.items()}
    chosen = FilterSet.of(spark, filters)
    got = {r["filter"]: (r["class"], r.n_overlaps) for r in overlap_classes(chosen).collect()}
    assert got == {f: (label[f], sum(x == f for x, _ in pairs)) for f in filters}
    one = rng.choice(filters)
    assert sorted(r["filter"] for r in overlaps_of(chosen, one).collect()) == sorted(y for x, y in pairs if x == one)


def test_many_filters_of_one_key_are_one_class_each_listed_once(spark):
    filters = spark.range(20_000).select(F.concat(F.lit("a."), F.col("id").cast("string"), F.lit(".x")).alias("filter")) \
        .union(spark.createDataFrame([("a.*.x",), ("a.>",), ("b.>",)], "filter string"))
    found = overlap_classes(FilterSet.of(spark, filters))
    assert found.count() == 20_003
    assert {r["filter"]: r.n_overlaps for r in found.where("n_overlaps <> 2").collect()} == {"a.*.x": 20_001, "a.>": 20_001, "b.>": 0}
    assert found.select("class").distinct().count() == 2
