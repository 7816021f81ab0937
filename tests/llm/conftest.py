"""Fixtures: rows with every odd value that the operators' docstrings define."""

import pytest

ODD = [None, "", "   ", "\n\n", "x", "x", "the the the the", "é" * 5000, "word " * 4000, "🙂 日本語", "a\x00b", "▁ ▁", "<s> </s> <|endoftext|>"]


@pytest.fixture(scope="session")
def odd(spark):
    """Null and empty texts, repeated rows, long texts, a null id, and extra columns with clashing names."""
    rows = [(i, t, "en", "src0", 1, 7, "w") for i, t in enumerate(ODD)] + [(4, "x", "en", "src0", 1, 7, "w"), (None, "no id here", None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_tokens long, score string")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
