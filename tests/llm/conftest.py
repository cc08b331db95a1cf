from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, clashing extra columns."""
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "Two words."), (5, "Two words."), (None, "Two words."),
            (6, "é à　ü 日本 語"), (7, long), (8, "x" * 50_000), (9, "a\n\nb\nc\n"), (9, "other text here"), (None, None)]
    extra = ", row int, key string, score string, block int, row_key string"
    return spark.createDataFrame([(*r, 1, "k", "s", 2, "x") for r in rows], DOCS + extra)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS + ", row int, key string, score string")


@pytest.fixture(scope="session")
def prose():
    """A seeded maker of prose: prose(n) gives n words."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(2, 9))) for _ in range(3000)]

    def make(n: int) -> str:
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    return make
