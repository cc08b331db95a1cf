from __future__ import annotations

import random

import pytest
from fixtures import column, log_of, message
from pyspark.sql import functions as F

from msglog.functions import subjects as S
from msglog.operators.splits import FilterSet, check_no_overlap, match_filters, match_splits, multi_match, overlapping, values

WORDS = ["a", "b", "c"]


def plain_match(filter_: str, subject: str) -> bool:
    f, s = filter_.split("."), subject.split(".")
    for i, token in enumerate(f):
        if token == ">":
            return len(s) > i
        if i >= len(s) or token not in ("*", s[i]):
            return False
    return len(f) == len(s)


def all_subjects(depth: int) -> list[str]:
    level, out = [""], []
    for _ in range(depth):
        level = [f"{p}.{w}" if p else w for p in level for w in WORDS]
        out += level
    return out


def random_filters(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        tokens = [rng.choice([*WORDS, "*"]) for _ in range(rng.randint(0, 3))]
        if not tokens or rng.random() < 0.4:
            tokens.append(">")
        out.add(".".join(tokens))
    return sorted(out)


SUBJECTS = all_subjects(4)


@pytest.fixture(scope="module")
def log(spark):
    return log_of(spark, [message(i + 1, s) for i, s in enumerate(SUBJECTS)]).cache()


@pytest.mark.parametrize("bad", ["", "foo..bar", ".a", "a.", "a.>.b", "a b.c", ">.a"])
def test_invalid_filters_are_rejected(spark, bad):
    with pytest.raises(ValueError):
        S.tokens_of(bad)
    table = values(spark, [{"filter": bad}])
    assert column(table.select(S.is_valid_filter(F.col("filter")).alias("v")), "v") == [False]
    with pytest.raises(ValueError):
        FilterSet.of(spark, table)


@pytest.mark.parametrize("filter_", ["a", "a.b", "a.*", "*", ">", "a.>", "*.b", "*.>", "a.*.c", "a.*.>", "*.*.b.*"])
def test_one_filter_matches_like_the_definition(log, filter_):
    got = sorted(column(log.where(S.matches(filter_)), "subject"))
    assert got == sorted(s for s in SUBJECTS if plain_match(filter_, s))


@pytest.mark.parametrize("filters", [["a.b", "c"], ["a.>", "*.b.c"], ["a.*", "b.*.c", ">"], ["a.b", "c.>"], ["a.*.c", "a.b"]])
def test_any_of_several_filters(log, filters):
    got = sorted(column(log.where(S.matches_any(filters)), "subject"))
    assert got == sorted(s for s in SUBJECTS if any(plain_match(f, s) for f in filters))


def expected_pairs(filters):
    return sorted((s, f) for f in filters for s in SUBJECTS if plain_match(f, s))


def pairs(df):
    return sorted((r["subject"], r["filter"]) for r in df.select("subject", "filter").collect())


def test_short_lists_match_inline(spark, log):
    filters = random_filters(8, seed=1)
    chosen = FilterSet.of(spark, filters)
    assert chosen.inline
    assert pairs(match_filters(log, chosen)) == expected_pairs(filters)


def test_disjoint_filters_give_the_same_rows(spark, log):
    filters = ["a.*", "b.>", "a.b.c", "c"]
    chosen = FilterSet.of(spark, filters)
    assert pairs(match_filters(log, chosen, disjoint=True)) == expected_pairs(filters)
    inline = match_splits(log, chosen, "job", disjoint=True)
    joined = match_splits(log, FilterSet.of(spark, values(spark, [{"filter": f} for f in filters])), "job")
    key = ["stream_seq", "filter", "consumer", "split_id"]
    assert sorted(map(tuple, inline.select(*key).collect())) == sorted(map(tuple, joined.select(*key).collect()))


@pytest.mark.parametrize("as_table", [False, True])
def test_many_filters_match_by_candidate(spark, log, as_table):
    filters = random_filters(60, seed=2)
    chosen = FilterSet.of(spark, values(spark, [{"filter": f} for f in filters]) if as_table else filters)
    assert not chosen.inline and chosen.size == 60
    assert pairs(match_filters(log, chosen)) == expected_pairs(filters)


def test_large_filter_tables_are_not_broadcast(spark, log, monkeypatch):
    from msglog.operators import splits

    filters = random_filters(60, seed=3)
    monkeypatch.setattr(splits, "BROADCAST_ROWS", 10)
    matched = match_filters(log, FilterSet.of(spark, filters))
    assert pairs(matched) == expected_pairs(filters)
    assert "ResolvedHint" not in matched._jdf.queryExecution().analyzed().toString()


def test_regex_characters_are_literal(spark):
    log = log_of(spark, [message(1, "a+.x.1"), message(2, "aa.x.1"), message(3, "a+.y.1")])
    assert column(log.where(S.matches("a+.*.1")), "stream_seq") == [1, 3]


def test_wildcard_looking_tokens_do_not_match_twice(spark, log):
    odd = log_of(spark, [message(1, "a.*")])
    table = FilterSet.of(spark, values(spark, [{"filter": "a.*"}, {"filter": "a.b"}]))
    assert pairs(match_filters(odd, table)) == [("a.*", "a.*")]


def test_multi_match(spark, log):
    filters = random_filters(12, seed=4)
    matched = match_filters(log, FilterSet.of(spark, filters))
    want = {s: sum(plain_match(f, s) for f in filters) for s in SUBJECTS}
    got = {SUBJECTS[r.stream_seq - 1]: r.n_filters for r in multi_match(matched).collect()}
    assert got == {s: n for s, n in want.items() if n > 1}


OVERLAPS = [
    ("foo.*", ">", True), ("foo.*", "*.*", True), ("foo.*", "foo.bar", True), ("foo.>", ">", True),
    ("foo.>", "*.>", True), ("foo.>", "foo.bar", True), ("a", "b", False), ("a.x", "b.y", False),
    ("a", "b.c", False), ("foo", "foo.>", False), ("a.*.c", "a.b.>", True), ("a.b.>", "a.c.>", False),
    ("*.b", "a.*", True), ("*.b", "a.c", False), ("a.*.>", "a.b", False),
]


@pytest.mark.parametrize("a,b,clash", OVERLAPS)
def test_overlap_of_two(spark, a, b, clash):
    found = overlapping(FilterSet.of(spark, [a, b])).collect()
    assert bool(found) is clash
    if clash:
        with pytest.raises(ValueError, match="overlapping"):
            check_no_overlap(spark, [a, b])


def test_overlap_of_many_is_set_intersection(spark):
    filters = random_filters(40, seed=5)
    subjects = all_subjects(5)
    sets = {f: {s for s in subjects if plain_match(f, s)} for f in filters}
    want = sorted((a, b) for a in filters for b in filters if a < b and sets[a] & sets[b])
    got = sorted((r.a, r.b) for r in overlapping(FilterSet.of(spark, filters)).collect())
    assert got == want
    assert want == sorted((a, b) for a in filters for b in filters if a < b and S.collide(a, b))
    with pytest.raises(ValueError, match="overlapping"):
        check_no_overlap(spark, filters)


def test_long_lists_become_a_table(spark, log):
    filters = [f"x.{i}" for i in range(600)] + ["a.*"]
    check_no_overlap(spark, filters)
    assert pairs(match_filters(log, FilterSet.of(spark, filters))) == expected_pairs(["a.*"])


def test_empty_token_is_an_error_not_an_overlap(spark):
    with pytest.raises(ValueError, match="empty token"):
        check_no_overlap(spark, ["foo..bar", "foo.*"])


def test_consumer_name_is_stable_and_short(spark):
    named = values(spark, [{"filter": "a.>"}, {"filter": "b.>"}]).select(
        S.consumer_name("job", F.col("filter")).alias("c"), S.split_id(F.lit("s"), F.lit("c")).alias("id")).collect()
    assert len({r.c for r in named}) == 2 and all(r.c.startswith("job-") and len(r.c) == 9 for r in named)
    assert named[0].id == "s > c"


def test_token_columns_narrow_but_do_not_change_the_result(spark):
    log = log_of(spark, [message(1, "a.x.7"), message(2, "a.x.07"), message(3, "a.y.7"), message(4, "a.x.8")]) \
        .withColumn("t", F.get(F.split("subject", r"\."), F.lit(2)).cast("long"))
    tokens = {2: ("t", "bigint")}
    assert column(log.where(S.matches("a.*.7", tokens=tokens)), "stream_seq") == [1, 3]
    assert column(log.where(S.matches("a.*.x", tokens=tokens)), "stream_seq") == []
    assert column(log.where(S.subject_in(["a.x.7", "a.x.8"], tokens=tokens)), "stream_seq") == [1, 4]
    assert column(log.where(S.subject_in(["a.x.7", "a.x"], tokens=tokens)), "stream_seq") == [1]
    assert column(log.where(S.subject_like("a.x.7%", tokens=tokens)), "stream_seq") == [1]
    assert column(log.where(S.subject_eq("a.x.07", tokens=tokens)), "stream_seq") == [2]
