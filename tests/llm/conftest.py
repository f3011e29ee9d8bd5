from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source) rows."""
    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture
def clashing(spark):
    """Adds columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    names = ["digest", "size", "n", "gram", "spans", "component", "slice", "kept", "word",
             "target", "copies", "finish", "length", "stream", "text_hash", "score", "id", "set"]
    return lambda docs: docs.select("*", *[F.lit(1).alias(name) for name in names])


@pytest.fixture
def prose():
    """Random prose: f(number of words, seed)."""
    def build(count, seed, vocabulary=3000):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(count))

    return build
