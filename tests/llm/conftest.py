from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture()
def docs_of(spark):
    """A documents frame of (doc_id, text) pairs."""

    def make(pairs):
        rows = [(i, t, "en", "test", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS)

    return make


ODD = [
    (None, None),
    (None, "a null id"),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "word"),
    (5, "same words twice over here"),
    (5, "same words twice over here"),
    (6, "x" * 30_000),
    (7, "é\x00ü 🙂 ▁   end"),
]


@pytest.fixture()
def odd(docs_of):
    """Nulls in every column, empty and long texts, repeated rows and a further column."""
    from pyspark.sql import functions as F

    frame = docs_of(ODD).withColumn("term", F.lit("clash")).withColumn("row", F.lit(1))
    return frame.withColumn("lang", F.lit(None).cast("string"))


@pytest.fixture()
def nothing(docs_of):
    return docs_of([])
