from __future__ import annotations

import random

import pytest

from rondo.llm.store import share_code

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names the operators use themselves."""
    share_code(spark)

    def documents(pairs, extra=True):
        rows = [(i, t, None if k % 7 == 0 else "en", f"src{k % 3}", None) for k, (i, t) in enumerate(pairs)]
        df = spark.createDataFrame(rows, SCHEMA)
        return df.selectExpr("*", "'x' AS id", "1 AS n", "'y' AS kept", "2 AS bucket") if extra else df

    return documents


@pytest.fixture(scope="session")
def prose():
    """Random words, always the same for a seed."""

    def words(seed, n, vocabulary=4000):
        draw = random.Random(seed)
        return [f"w{draw.randrange(vocabulary)}" for _ in range(n)]

    return words
