from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

ROOT = "/root/testdata"


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of (doc_id, text, ...) as documents, with columns that clash with results."""

    def make(rows):
        full = [(i, t, "score", "keep", 1, True) for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, score string, component string, n_tokens int, kept boolean"
        )

    return make


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{ROOT}/sf0.001/documents.parquet")


#: Rows with nulls, empty and long texts, repeats and ties.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (None, "a text without an id"), (4, "one"),
    (5, "the same words " * 30), (5, "the same words " * 30), (6, "the same words " * 30),
    (7, "x" * 70_000), (8, "Ein\x0bWort é́ 日本語 <|endoftext|> 's"),
    (9, "word " * 9_000), (None, None), (10, "line\n" * 300),
]


@pytest.fixture(scope="session")
def odd():
    return ODD
