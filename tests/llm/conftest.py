"""Rows that every operator must stand: nulls, empty and long texts, ties, repeats, clashing extra columns."""

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use for columns of their own
        *(T.StructField(n, T.StringType()) for n in ("spans", "score", "rep", "component", "shard", "row", "toxic", "quality", "n")),
    ]
)


def make_docs(spark, texts):
    extra = ["x"] * 9
    return spark.createDataFrame([(i, t, None, None, None if t is None else len(t), *extra) for i, t in texts], SCHEMA)


ODD = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (4, "one"),
    (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    (7, " ".join(f"word{i}" for i in range(30000))),
    (8, "é ß 漢字 🙂 naïve"),
    (9, " " * 5000),
]


@pytest.fixture(scope="session")
def odd(spark):
    return make_docs(spark, ODD)


@pytest.fixture(scope="session")
def no_docs(spark):
    return make_docs(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 1, 0), (8, 0, 1), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
