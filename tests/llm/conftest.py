from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

WORDS = "the of and to in is that it was for on are as with his they at be this from have or by one had not but what all were".split()

#: Rows with which every operator must cope: nulls, empty and blank texts, repeated rows, ties, an unusual alphabet.
ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, "word"), (5, "word"), (5, "word"), (6, "Ünï çödé 𝄞 文字 " * 12), (7, "word word"),
       (8, "ONE two THREE four five six seven eight"), (9, "one TWO three FOUR five six seven eight"), (None, "no id here"),
       (10, "'s don't \"it's\"  \r\n x"), (11, "a" * 700)]

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()),
                       # names that operators use inside
                       T.StructField("key", T.StringType()), T.StructField("node", T.IntegerType()),
                       T.StructField("count", T.LongType()), T.StructField("row", T.DoubleType())])


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed", "ing"]) for _ in range(n))


@pytest.fixture(scope="session")
def table(spark):
    """A table of documents with extra columns, from (doc_id, text) pairs."""
    def make(rows):
        full = [(i, t, "en", "src", None if t is None else len(t), "k", 1, 2, 0.5) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


@pytest.fixture(scope="session")
def odd(table):
    return table(ODD)


@pytest.fixture(scope="session")
def none(table):
    return table([])
