from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from msglog.llm import packing


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


@pytest.fixture(scope="module")
def coder():
    return packing.ByteTokenizer(packing.default_tokenizer())


def ids(coder, text):
    return np.frombuffer(next(iter(coder.ids([text]))), dtype="<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=st.sampled_from("ab é.,'\n\t　日1 "), max_size=40))
def test_ids_are_those_of_the_library(library, coder, text):
    assert ids(coder, text) == library.encode(text, add_special_tokens=False).ids


def test_special_tokens_and_a_full_memo(library, coder, monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 3)
    for text in ("a <|endoftext|> b", "<|endoftext|>", "one two three four five six", " lead", "trail ", ""):
        assert ids(coder, text) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(lengths=st.lists(st.integers(1, 20), max_size=80), bins=st.integers(1, 5))
def test_best_fit_fills_without_gaps_or_overflow(lengths, bins):
    sequence, offset = packing.best_fit(np.array(lengths, dtype=np.int64), 20, bins)
    filled = defaultdict(int)
    for n, s, o in zip(lengths, sequence.tolist(), offset.tolist(), strict=True):
        assert filled[s] == o
        filled[s] += n
        assert filled[s] <= 20


def test_best_fit_takes_the_fullest_that_fits_and_closes_the_fullest():
    sequence, _ = packing.best_fit(np.array([5, 7, 3, 5]), 10, 8)
    assert sequence.tolist() == [0, 1, 1, 0]  # 3 fits both, the fuller takes it
    sequence, _ = packing.best_fit(np.array([9, 6, 7, 1]), 10, 2)
    assert sequence.tolist() == [0, 1, 2, 2]  # 9 was closed for 7


def test_packed_documents(spark, odd, library):
    rows = packing.pack_documents(odd, length=64).collect()
    texts = sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=str)
    want = []
    for doc_id, text in texts:
        all_ids = library.encode(text, add_special_tokens=False).ids + [0]
        start, piece = 0, 0
        while start < len(all_ids):
            size = 64 if start else (len(all_ids) - 1) % 64 + 1
            part = np.array(all_ids[start:start + size], dtype="<u4").tobytes()
            want.append((doc_id, piece, start, size, zlib.crc32(part)))
            start, piece = start + size, piece + 1
    assert sorted((tuple(r[:5]) for r in rows), key=str) == sorted(want, key=str)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(places) <= -(-sum(r.length for r in rows) // 64) + 1


def test_no_documents(none):
    assert packing.pack_documents(none).count() == 0


def test_whole_pieces_are_sequences_of_their_own_and_are_not_sent_to_one_task(spark):
    rows = spark.range(2000).selectExpr("id as doc_id", "0 as piece", "0L as start", "16L as length", "id as ids_crc32")
    some = spark.range(30).selectExpr("id + 5000 as doc_id", "0 as piece", "0L as start", "5L as length", "id as ids_crc32")
    packed = packing.pack(rows.repartition(8).union(some.coalesce(1)), length=16, pieces_per_task=100)
    got = packed.collect()
    assert len({r.sequence_id for r in got if r.length == 16}) == 2000 and all(r.offset == 0 for r in got if r.length == 16)
    assert not {r.sequence_id for r in got if r.length == 16} & {r.sequence_id for r in got if r.length < 16}
    assert len({r.sequence_id for r in got if r.length < 16}) == 10  # three of five tokens in each
    assert "Exchange" in packed._jdf.queryExecution().toString()
    whole = packed.where("length = 16")
    assert "Exchange" not in whole._jdf.queryExecution().optimizedPlan().toString() or whole.rdd.getNumPartitions() > 1


def plain_best_fit(lengths: list[int], length: int, open_bins: int) -> list[tuple[int, int]]:
    """Best fit by looking at every open sequence."""
    free, made, out = {}, 0, []
    for need in lengths:
        fits = [(space, -order, at) for at, (space, order) in free.items() if space >= need]
        if fits:
            space, _, at = min(fits)
        else:
            space, at, made = length, made, made + 1
            if need < length and len(free) == open_bins:
                del free[min(free, key=lambda x: (free[x][0], -free[x][1]))]
        out.append((at, length - space))
        free.pop(at, None)
        if space > need:
            free[at] = (space - need, len(out))
    return out


@settings(max_examples=200, deadline=None)
@given(lengths=st.lists(st.integers(1, 12), max_size=60), open_bins=st.integers(1, 6))
def test_placement_agrees_with_a_plain_best_fit(lengths, open_bins):
    sequence, offset = packing.best_fit(np.array(lengths, dtype=np.int64), 12, open_bins)
    assert list(zip(sequence.tolist(), offset.tolist(), strict=True)) == plain_best_fit(lengths, 12, open_bins)
