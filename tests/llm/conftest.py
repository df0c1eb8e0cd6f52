from __future__ import annotations

import pytest

import __spark_entry__  # noqa: F401  the workers get the code by value
from tests.llm.brute import SCHEMA


@pytest.fixture
def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and clashing column names."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    shared = "this very line is found in quite a few of the documents here"
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n ", None, "a", None),
        (4, long, "en", "a", 1),
        (None, f"no id at all\n{shared}", "en", None, 1),
        (None, None, None, None, None),
        (6, f"{shared}\nx", "de", "b", 1),
        (6, f"{shared}\nx", "de", "b", 1),
        (7, f"{shared}\ny", "de", "b", 1),
        (8, f"{shared}\nz", "de", None, 1),
        (9, f"{shared}\n{shared}", "de", "b", 1),
        (10, f"{shared} \n mail a.b@c.example.org", "de", "b", 1),
        (11, "one", "de", "b", 1),
        (12, "one", "de", "b", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    clashing = "size copies copy_no n_lines n_dropped n_words kept score predicted row pos part h1 id spans batch token home"
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit("x").alias(c) for c in clashing.split()])


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
