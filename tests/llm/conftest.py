"""Small tables for the operators of this folder."""

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        T.StructField("row_key", T.StringType()),
        T.StructField("fp", T.StringType()),
        T.StructField("Hash", T.StringType()),
        T.StructField("size", T.StringType()),
    ]
)


def documents(spark, rows):
    """Rows of (id, text[, source]) with the columns of ``documents`` and some with clashing names."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "web", len(r[1] or ""), "k", "f", "h", "s") for r in rows]
    return spark.createDataFrame(full, DOCS)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture
def rng():
    return random.Random(5)
