import random

import pytest
from pyspark.sql import types as T

#: Extra columns whose names the operators use themselves.
CLASHING = ("size", "key", "first", "unit", "n_words", "copies", "place", "rep")


@pytest.fixture(scope="session")
def frame(spark):
    """documents with clashing extra columns from (doc_id, text, source) rows."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("source", T.StringType()),
            *[T.StructField(name, T.StringType()) for name in CLASHING],
        ]
    )

    def make(rows):
        return spark.createDataFrame([(*r, *CLASHING) for r in rows], schema)

    return make


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Nulls, empty and long texts, repeated rows, near and exact copies, equal lines."""
    long = prose(1, 6000)
    near = prose(2, 300, 5000).split()
    lines = "\n".join(prose(100 + k, 12) for k in range(12))
    found = [
        (0, None, "b"),
        (1, "", "b"),
        (2, " \n\t ", None),
        (3, "one two", "a"),
        (4, long, "a"),
        (4, long, "a"),
        (5, long, "c"),
        (6, "The MIT License, and the Apache License, Version 2.0. cc-by CC BY", "c"),
        (None, "no id " + prose(3, 40), None),
        (7, " ".join(near), "a"),
        (8, " ".join(near[:150] + ["edit"] + near[150:]), "a"),
        (9, " ".join(near[5:]), "é"),
        (10, lines, "a"),
        (11, "An extra line in front\n" + lines + "\nand one behind", "b"),
        (12, "echo " * 500, "a"),
        (13, "Ünïcödé ςΣ 🙂 " * 60, "z"),
        (14, "one TWO", "a"),
    ]
    return found + [(20 + k, prose(50 + k, 30 + 7 * k), "abc"[k % 3]) for k in range(25)]
