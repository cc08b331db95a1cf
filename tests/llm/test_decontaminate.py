from __future__ import annotations

import random

import numpy as np
import pytest

from msglog.llm import decontaminate as D

ITEMS = "item_id long, text string"


def brute_align(doc, item):
    """Best Smith-Waterman score, cell by cell."""
    score = [[0] * (len(item) + 1) for _ in range(len(doc) + 1)]
    for i, a in enumerate(doc, 1):
        for j, b in enumerate(item, 1):
            score[i][j] = max(0, score[i - 1][j - 1] + (D.MATCH if a == b else D.MISMATCH), score[i - 1][j] + D.GAP, score[i][j - 1] + D.GAP)
    return max(map(max, score))


def test_alignment_scores_agree_with_the_full_table():
    rng = np.random.default_rng(6)
    for _ in range(60):
        doc, item = rng.integers(0, 4, (3, rng.integers(1, 15))), rng.integers(0, 4, (3, rng.integers(1, 12)))
        score, first, last = D.align(doc, item)
        assert score.tolist() == [brute_align(d.tolist(), i.tolist()) for d, i in zip(doc, item, strict=True)]
        for d, i, s, a, b in zip(doc, item, score, first, last, strict=True):
            if s:  # the named columns alone give the score
                assert brute_align(d[a:b].tolist(), i.tolist()) == s


@pytest.fixture(scope="module")
def planted(spark, prose):
    rng = random.Random(11)
    items = [(i, prose(40).capitalize() + ".") for i in range(20)] + [(50, None), (51, ""), (52, "two words"), (None, prose(30))]
    rows, want = [], set()
    for i in range(120):
        words = prose(rng.randint(0, 200)).split()
        if i % 4 == 0:
            item = items[rng.randrange(20)]
            passage = item[1].upper().split() if i % 8 else item[1].split()
            if i % 12 == 0:  # edited: two words dropped, two changed, one added
                passage[5] = passage[20] = "edited"
                del passage[30], passage[12]
                passage.insert(25, "added")
            words[len(words) // 2:len(words) // 2] = passage
            want.add((i, item[0]))
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, item_id int, key string")
    return docs, spark.createDataFrame(items, ITEMS), want


@pytest.mark.parametrize("block_items", [7, 1000])
def test_planted_copies_are_found_and_nothing_else(planted, block_items):
    docs, items, want = planted
    settings = D.Settings(block_items=block_items)
    got = D.contaminated(docs, items, settings=settings).collect()
    assert {(r.key, r.item_id) for r in got} == want
    assert all(r.score >= 0.5 and 30 <= r.last_word - r.first_word <= 45 for r in got)
    kept = D.uncontaminated(docs, items, settings)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in range(120)} - {d for d, _ in want}


def test_an_item_copied_everywhere_keeps_its_seeds(spark, prose):
    item = prose(35)
    docs = spark.createDataFrame([(i, f"{prose(30)} {item} {prose(30)}") for i in range(60)], "doc_id long, text string")
    got = D.contaminated(docs, spark.createDataFrame([(1, item)], ITEMS)).collect()
    assert sorted(r.key for r in got) == list(range(60)) and all(r.score == 1.0 for r in got)


@pytest.mark.parametrize("step", [5, 8])
def test_edited_copies_in_many_documents_are_found(spark, prose, step):
    # Every stretch of six 3-grams holds one that stands in no document, and the others are not rare.
    item = prose(40).split()
    copy = " ".join("edited" if i % step == step - 1 else w for i, w in enumerate(item))
    rows = [(i, f"{prose(30)} {copy} {prose(30)}" if i < 60 else prose(100)) for i in range(100)]
    docs, items = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], ITEMS)
    assert sorted(r.key for r in D.contaminated(docs, items).collect()) == list(range(60))
    assert sorted(r.doc_id for r in D.uncontaminated(docs, items).collect()) == list(range(60, 100))


def test_meetings_gathered_by_parts_give_the_same_hits(prose, monkeypatch):
    texts = [prose(40) for _ in range(30)]
    items = D.Items([(i, t) for i, t in enumerate([*texts, texts[0], "two words"])], 3).seeded()
    docs = [f"{prose(50)} {t} two words {prose(20)} {texts[0]}" for t in texts]
    want = D._hits(docs, items, D.Settings())
    monkeypatch.setattr(D, "MEETINGS", 7)
    assert D._hits(docs, items, D.Settings()) == want and len(want) >= 110


def all_seeds(items, h, row, starts, counts, found, slack):
    """The windows of every n-gram that a text and an item share."""
    met = [(p, s) for position, code in found for p, c in zip(position.tolist(), code, strict=True) for s in np.flatnonzero(items.gram == c).tolist()]
    at, seed = np.array(sorted(met), dtype=np.int64).reshape(-1, 2).T
    return D._joined(items, row, starts, counts, at, seed, slack)


@pytest.mark.parametrize("letters", ["ab", "abcdef", "abcdefghijklmnopqrst"])
def test_the_rarest_seed_of_each_run_gives_the_windows_of_all_seeds(letters):
    rng = random.Random(len(letters))
    for _ in range(40):
        items = D.Items([(i, " ".join(rng.choices(letters, k=rng.randint(1, 14)))) for i in range(12)], 3).seeded()
        h, row, starts, found = D._positions([" ".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(4)] + ["", "a b c"], items.sizes)
        args = items, h, row, starts, np.bincount(row, minlength=6), found, 2
        got = [np.concatenate(x).tolist() for x in zip(*D._windows(*args), strict=True)] or [[]] * 4
        want = all_seeds(*args)
        assert got == [x.tolist() for x in want]


def test_a_template_of_many_items_is_one_seed(prose, monkeypatch):
    template = prose(20)
    rows = [(i, f"{template} {prose(20)}") for i in range(300)]
    items = D.Items(rows, 3).seeded()
    seeds = []
    joined = D._joined
    monkeypatch.setattr(D, "_joined", lambda i, r, s, c, at, seed, slack: seeds.append(len(seed)) or joined(i, r, s, c, at, seed, slack))
    text = f"{prose(30)} {rows[7][1]} {prose(30)}"
    hits = D._hits([text], items, D.Settings())
    assert (0, 7, 1.0, 30, 70) in hits
    assert sum(seeds) < 600  # 18 n-grams of the template stand in 300 items each


@pytest.mark.parametrize("copies", [2, 5, 12])
def test_copies_next_to_each_other_each_get_a_row(prose, copies):
    item = prose(40)
    items = D.Items([(1, item)], 3).seeded()
    for between in (0, 1, 15):
        text = prose(30) + "".join(f" {item} {prose(between)}" for _ in range(copies)) + prose(30)
        want = [(0, 0, 1.0, 30 + i * (40 + between), 70 + i * (40 + between)) for i in range(copies)]
        assert D._hits([text], items, D.Settings()) == want

def test_odd_rows(spark, odd, none, planted):
    items = planted[1].where("item_id is null or item_id <> 52")
    assert D.contaminated(odd, items).count() == 0
    assert D.contaminated(none, items).count() == 0
    assert D.contaminated(odd, items.limit(0)).count() == 0
    kept = D.uncontaminated(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    tiny = spark.createDataFrame([(9, "two words")], ITEMS)
    assert sorted((r.key or 0) for r in D.contaminated(odd, tiny).collect()) == [0, 5, 5]


def test_repeated_items_are_looked_for_once_and_blocks_are_bounded_by_bytes(spark, prose):
    text = prose(40)
    items = [(1, text)] * 50 + [(2, text), (3, prose(40))]
    asked = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(1, f"{prose(20)} {text} {prose(20)}"), (2, prose(90))], "doc_id long, text string")
    blocks = [sent.value for sent in D._seeded(docs, asked, D.Settings(block_bytes=len(text)))]
    assert len(blocks) >= 2 and sorted(t for b in blocks for t in b.times) == [1, 1, 50]
    found = D.contaminated(docs, asked, settings=D.Settings(block_bytes=len(text))).collect()
    assert sorted((r.key, r.item_id) for r in found) == [(1, 1)] * 50 + [(1, 2)]
