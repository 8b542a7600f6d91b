from __future__ import annotations

import pytest

TEXTS = [None, "", " \t\n", "one", "one two three four five", "x" * 70000, "ß Ünï 🙂 " * 30]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, a null id, and columns with clashing names."""
    rows = [(i, t, None if i % 3 else "en", "s", -1, 5) for i, t in enumerate(TEXTS)]
    rows += [rows[3], (None, "a text without an id", None, None, None, None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score int"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.filter("false")


@pytest.fixture(scope="session")
def base():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, base):
    return spark.read.parquet(f"{base}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {row["doc_id"]: row["text"] or "" for row in documents.select("doc_id", "text").collect()}
