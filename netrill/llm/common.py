"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netrill.session import shared_folder

#: White space of the word contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def held(frame: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a one-element explode.

    Lambdas over an array may only refer to it by name: were the projection that makes
    it merged into the lambda, it would be made again for every element.
    """
    made = F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))
    out = frame.select("*", F.explode_outer(made).alias("_held"))
    return out.select(*frame.columns, *[F.col("_held")[name].alias(name) for name in columns])


def written(frame: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: it cuts lineage and outlives executors."""
    spark = frame.sparkSession
    path = shared_folder(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def by_column(frame: DataFrame, **columns: Column) -> DataFrame:
    """Select new columns; `columns` are built from the frame's own, so clashing names can't matter."""
    return frame.select(*[value.alias(name) for name, value in columns.items()])


def discarded(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate rows that this run has written and nothing reads again."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
