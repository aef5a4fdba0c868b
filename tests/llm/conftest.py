from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF):
        pytest.skip("driver tables are not there")
    return SF


@pytest.fixture(scope="session")
def corpus(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a long text, and columns with clashing names."""
    long = " ".join(f"w{i % 997}x{i % 31}" for i in range(30_000))
    words = [f"alpha{i} beta{i} gamma delta" for i in range(40)]
    texts = [
        (1, " ".join(words), "en"),
        (2, " ".join(words[:-1] + ["omega psi"]), "en"),
        (3, " ".join(words), "en"),
        (3, " ".join(words), "en"),
        (4, None, "en"),
        (5, "", None),
        (6, " \t\n", "de"),
        (7, "one two", "de"),
        (8, "ONE two", "de"),
        (None, "words of a row without a number " * 4, "en"),
        (9, long, "en"),
        (10, "Ünïcode Straße ÀÉ 12 #hash", "de"),
    ]
    rows = [(i, t, lang, "src", 5, 1, 2, 3.0) for i, t, lang in texts]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, word long, k int, token int, score double"
    )


@pytest.fixture(scope="session")
def nothing(corpus):
    return corpus.limit(0)
