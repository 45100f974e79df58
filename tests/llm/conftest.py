from __future__ import annotations

import pytest

#: Cases that every text operator must bear: null, empty, blanks, repeats, very long, odd characters.
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (3, None),
    (4, ""),
    (5, "   \t\n "),
    (6, "word " * 3000),
    (7, "x" * 20_000),
    (8, "日本語 ünïcödé 😀 <|endoftext|> � tab\there\nline two of it\n\nline two of it"),
    (9, "short"),
    (None, "a row without an id but with some words in it"),
    (2, "a second row with the id two"),
]


@pytest.fixture
def odd(spark):
    """Odd rows with extra columns whose names the operators use inside."""
    rows = [(i, t, "en" if t else None, None if i == 1 else "s", 1, 2, 3) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept int, _keep int, block int")


@pytest.fixture
def none(odd):
    return odd.filter("false")
