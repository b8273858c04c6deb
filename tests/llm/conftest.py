from __future__ import annotations

import pytest
from pyspark.sql import functions as F

MESSY = "doc_id long, text string, blob string, fp long, words string, node int"


@pytest.fixture(scope="module")
def messy(spark):
    """Nulls, empty and very long texts, repeats and ties, and columns named like those inside the operators."""
    long_one = " ".join(f"w{i % 997}x{i}" for i in range(20_000))
    rows = [
        (1, "Hello world, foo bar baz!"),
        (1, "Hello world, foo bar baz!"),
        (2, None),
        (3, ""),
        (None, "some text without an id"),
        (4, long_one),
        (5, "hello world, foo bar baz!"),
        (6, "  \n\t "),
        (7, "it's don't <|endoftext|>x  é é İ Σς 00 0a \x1c a b"),
    ]
    return spark.createDataFrame([(i, t, "b", 7, "w", 1) for i, t in rows], MESSY).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark, messy):
    return messy.where(F.lit(False))


def answer(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
