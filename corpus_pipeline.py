"""Documents through five stages: toxicity, near-duplicates, decontamination, privacy, encoding.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and returns the
columns of documents; the last one returns token counts and digests. `run` writes each
stage's rows as Parquet in the shared folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from netrill.llm import decontamination, near_duplicates, pieces, privacy, toxicity
from netrill.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the machine learnt from `labels` rejects."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_duplicates.distinct(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a passage of `benchmark`."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def remove_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and revealing words replaced by their kind."""
    return privacy.sanitised(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return pieces.encoded(docs, pieces.default_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("privacy", remove_private),
    ("sentencepiece", encode),
]

#: The classifier can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
