from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from msglog.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text: str | None) -> list[str]:
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs: list, items: list, keep: int = 20) -> list:
    """Every document scored for every item."""
    held = [(i, Counter(plain_terms(t)), len(plain_terms(t))) for i, t in docs if plain_terms(t)]
    n, total = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in dict.fromkeys((i, t) for i, t in items if t is not None):
        scores = []
        for place, (doc, counts, length) in enumerate(held):
            m = 100 - 25 + (25 * length * n) // total
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 12 * m))
                        for t, times in Counter(plain_terms(text)).items() if t in counts)
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scores)[:keep], 1)]
    return sorted(out, key=str)


def found(spark, docs: list, items: list, **settings) -> list:
    rows = ranked.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
                         **settings).collect()
    return sorted(((r.item, r["rank"], r.doc_id, r.score) for r in rows), key=str)


def texts(n: int, seed: int, words: int = 60) -> list:
    """Texts of words of very unlike frequency."""
    rng = random.Random(seed)
    return [(i, " ".join(f"t{int(500 * rng.random() ** 4)}" for _ in range(rng.randint(1, words)))) for i in range(n)]


@pytest.mark.parametrize("settings", [{}, {"size": 30}, {"bundle": 2, "size": 64}, {"keep": 3, "size": 50}])
def test_ranking_agrees_with_scoring_everything(spark, settings):
    docs, items = texts(700, 1), texts(9, 2, 25)
    assert found(spark, docs, items, **settings) == plain(docs, items, settings.get("keep", 20))


def test_cutting_spares_accumulators_and_changes_nothing(spark):
    docs = texts(2000, 3)
    items = [(i, docs[i][1]) for i in range(5)]
    index = ranked.inverted(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), ranked.item_terms(
        spark.createDataFrame(items, "item_id long, text string"))[1])
    assert index.where("term is null").count() == 1
    assert found(spark, docs, items) == plain(docs, items)


def test_ties_go_by_id_and_repeated_rows_are_ranked_one_by_one(spark):
    docs = [(i, "same text here") for i in range(40, 0, -1)] + [(5, "same text here"), (None, "same text here"), (99, "unlike")] * 2
    items = [(1, "text HERE here"), (1, "text HERE here"), (1, "unlike"), (2, None), (3, ""), (4, "absent"), (None, "same")]
    assert found(spark, docs, items) == plain(docs, items)


def test_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, "two words"), (2, "日本 é"), (3, "w7 w8 W9 xx"), (4, "x" * 50_000)]
    asked = spark.createDataFrame([(*i, "s") for i in items], "item_id long, text string, score string")
    got = sorted(((r.item, r["rank"], r.doc_id, r.score) for r in ranked.search(odd, asked).collect()), key=str)
    assert got == plain(rows, items)
    assert ranked.search(none, asked).collect() == []
    assert ranked.search(odd, asked.limit(0)).collect() == []


def test_terms():
    assert ranked.terms("Ab_c-9É x{Z}~é") == [t.encode() for t in plain_terms("Ab_c-9É x{Z}~é")]
    assert ranked.terms(None) == []
