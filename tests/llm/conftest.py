from __future__ import annotations

import pytest
from pyspark.sql import types as T

# Columns beside those of documents, with names that operators use inside.
EXTRA = ["size", "word", "a.b", "_text", "_id", "row", "fp", "key", "doc", "line"]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in EXTRA],
    ]
)

BLANK = " \t\x0b"
SENTENCE = "the quick brown fox jumps over the lazy dog while seven wizards quietly boil green tea"
LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))

# Nulls in every column, empty, blank and very long texts, repeated rows, ties, equal texts, repeated ids.
ODD = [
    (1, SENTENCE, "en", "s1", 5),
    (1, SENTENCE, "en", "s1", 5),
    (2, None, "en", "s1", None),
    (3, "", None, None, 0),
    (4, BLANK, "en", "s2", 3),
    (5, "\n\n\n", "en", "s2", 3),
    (6, LONG, "en", "s1", len(LONG)),
    (7, LONG, "en", "s1", len(LONG)),
    (None, SENTENCE + "\n" + SENTENCE.upper(), "en", "s1", 1),
    (None, None, None, None, None),
    (8, SENTENCE + "\n" + SENTENCE, "de", "s3", 1),
    (9, "Été \U0001f600　x\n" + SENTENCE, "fr", None, 1),
    (10, "word", "en", "s1", 4),
    (10, "another word", "en", "s1", 12),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * len(EXTRA)) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 11)] + [(1, 0, 1), (2, None, None), (None, 1, 1), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
