"""Awkward documents that every operator must take."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, id string, size string, key string, at string, n string"


def make_rows(texts):
    """Rows of (doc_id, text), with columns whose names clash with the operators' own."""
    return [(i, x, ("en", "fr", None)[k % 3], ("a", "b", None)[k % 3], 1, "x", "y", "z", "s", "k", "t", "n") for k, (i, x) in enumerate(texts)]


TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (2, "the QUICK brown fox jumps over the lazy dog near the river bank today"),
    (3, "The quick brown fox jumps over the lazy cat near the river bank today"),
    (4, None),
    (5, ""),
    (6, " \t\n "),
    (7, "É"),
    (8, "é"),
    (9, "one"),
    (9, "one"),
    (10, "12345 67890 !!!"),
    (11, "word " * 30_000),
    (None, "no id here at all, only words"),
    (12, "Line one is here for all\nLine two is here for all\n\nLine one is here for all"),
    (13, "x" * 70_000),
]


@pytest.fixture()
def awkward(spark):
    return spark.createDataFrame(make_rows(TEXTS), SCHEMA)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
