"""Fixtures of awkward documents for the training-data operators."""

import pytest

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="session")
def awkward(spark):
    """Null and repeated ids, null, empty and long texts, repeated rows, clashing columns."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank"),
        (2, "the QUICK brown fox jumps over the lazy dog near the river bank"),
        (2, "the QUICK brown fox jumps over the lazy dog near the river bank"),
        (None, "The quick brown fox jumps over the lazy dog near the river bank"),
        (None, "no identifier here"),
        (3, None),
        (4, ""),
        (5, " \t\n "),
        (6, "Épatant \U0001f600 漢字  naïve\x0btext " * 300),
        (7, "word"),
        (8, "two words"),
        (9, "lone text that is like no other"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    clashing = "'x' as row", "1 as print", "'s' as sha", "true as kept", "2 as score", "'en' as lang"
    return frame.selectExpr("doc_id", "text", *clashing, "cast(length(text) as bigint) as n_chars")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.filter("false")
