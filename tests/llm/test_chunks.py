from __future__ import annotations

import random

from msglog.llm import chunks


def flagged(frame, **kw):
    return [r.asDict() for r in chunks.repeated_spans(frame, **kw).collect()]


def test_every_passage_of_over_50_words_is_found_whatever_is_around_it(prose):
    rng = random.Random(8)
    for _ in range(400):
        passage = prose(51)
        one, two = (prose(rng.randint(0, 120)) + rng.choice([" ", "\n", "  "]) + passage + " " + prose(rng.randint(0, 120)) for _ in "ab")
        assert {c[4] for c in chunks.text_chunks(one)} & {c[4] for c in chunks.text_chunks(two)}


def test_white_space_makes_no_difference(spark, prose):
    passage = prose(52)
    rows = [(1, f"{prose(60)} {passage} {prose(60)}"), (2, f"  {prose(30)}\n{passage.replace(' ', '  ')}\r\n\r\n{prose(70)}"),
            (3, f"{prose(80)}\t{passage.replace(' ', chr(13) + chr(10))}  ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r["doc_id"], r["kept"]) for r in flagged(docs)} == {(1, True), (2, False), (3, False)}
    kept = {r.doc_id: r.text for r in chunks.without_repeats(docs).collect()}
    for i, text in rows[1:]:
        w = text.split()
        begin = {2: 30, 3: 80}[i]
        got = kept[i].split()
        assert got[:begin] == w[:begin] and len(got) <= len(w) - 24 and (len(w) == begin + 52 or got[begin - len(w) + 52:] == w[begin + 52:])
    for _, text in rows:
        raw, words = text.encode(), text.split()
        for a, b, x, y, _ in chunks.text_chunks(text):
            assert raw[x:y].decode().split() == words[a:b]


def test_a_row_that_comes_often_is_cut_once(spark, prose):
    passage = prose(70)
    many = [(5, f"{prose(40)} {passage} {prose(40)}")] * 300
    docs = spark.createDataFrame([(1, f"{prose(30)} {passage}"), *many], "doc_id long, text string").repartition(6)
    kept = chunks.without_repeats(docs)
    texts = [r.text for r in kept.where("doc_id = 5").collect()]
    assert len(texts) == 300 and len(set(texts)) == 1 and 80 <= len(texts[0].split()) <= 126
    named = docs.select(chunks.F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")
    assert chunks.repeated_chunks(named).where("not first").count() >= 300


def test_insertions_move_no_distant_cut(prose):
    text = prose(2000)
    before, after = ({c[4] for c in chunks.text_chunks(t)} for t in (text, "inserted words here " + text))
    assert len(before - after) <= 5


def test_cut_points_are_window_minima():
    values = [5, 3, 3, 9, 1, 7, 7, 2, 8, 8, 8, 8]
    want = set()
    for i in range(len(values) - 3):
        window = values[i:i + 4]
        want.add(i + window.index(min(window)))
    import numpy as np

    assert set(chunks.cut_points(np.array(values, dtype=np.uint32), 4).tolist()) == want


def test_spans_mark_first_and_later_places(spark, prose):
    passage = prose(80)
    rows = [(10, prose(60) + " " + passage + " " + prose(60)), (4, prose(90) + "\n" + passage.upper() + "\n" + prose(40)),
            (7, prose(200)), (8, None), (9, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = flagged(frame)
    assert {(r["doc_id"], r["kept"]) for r in got} == {(4, True), (10, False)}
    for r in got:
        begin = {4: 90, 10: 60}[r["doc_id"]]
        assert begin <= r["start_word"] <= begin + 14 and begin + 66 <= r["end_word"] <= begin + 80
        assert r["copies"] == 2 and r["first_doc_id"] == 4


def test_repeats_agree_with_all_word_windows(spark, prose):
    """Every span is a real repeat, and every repeat of over 50 words touches a span."""
    shared = [prose(70) for _ in range(4)]
    rng = random.Random(2)
    rows = [(i, " ".join(p for _ in range(2) for p in (prose(rng.randint(5, 80)), rng.choice(shared)))) for i in range(12)]
    where = {}
    for i, text in rows:
        w = text.split()
        for at in range(len(w) - 23):
            where.setdefault(tuple(w[at:at + 24]), []).append((i, at))
    got = flagged(spark.createDataFrame(rows, "doc_id long, text string"))
    words = {i: t.split() for i, t in rows}
    for r in got:
        for at in range(r["start_word"], r["end_word"] - 23):
            assert len(where[tuple(words[r["doc_id"]][at:at + 24])]) > 1 or r["end_word"] - r["start_word"] > 24
    for i, w in words.items():
        for p in shared:
            p = p.split()
            for at in range(len(w) - len(p) + 1):
                if w[at:at + len(p)] == p and sum(" ".join(p) in t for _, t in rows) > 1:
                    assert any(r["doc_id"] == i and r["start_word"] < at + len(p) and r["end_word"] > at for r in got)


def test_cutting_keeps_first_places_and_other_columns(spark, prose):
    passage = prose(100)
    a, b, c, d = prose(50), prose(50), prose(50), prose(50)
    frame = spark.createDataFrame([(1, f"{a} {passage} {b}", 7, "x"), (2, f"{c} {passage} {d}", 8, "y"), (3, None, 9, None)],
                                  "doc_id long, text string, row int, cuts string")
    out = {r.doc_id: r for r in chunks.without_repeats(frame).collect()}
    assert out[1].text == f"{a} {passage} {b}" and out[3].text is None
    assert out[2].text.startswith(c) and out[2].text.endswith(d) and len(out[2].text.split()) < 130
    assert (out[2].row, out[2].cuts) == (8, "y")


def test_byte_ranges_of_wide_letters():
    assert chunks.without_spans("é à ü  ö", [(3, 5)]) == "é ü  ö"


def test_odd_rows(spark, odd, none, prose):
    assert chunks.repeated_spans(none).count() == 0
    assert chunks.without_repeats(none).count() == 0
    assert flagged(odd) == []
    twice = odd.where("doc_id = 7").union(odd.where("doc_id = 7"))  # one id twice: both hold the first place
    assert {r["kept"] for r in flagged(twice)} == {True}
    assert chunks.without_repeats(odd).count() == odd.count()
