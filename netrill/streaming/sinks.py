"""Fan-out of one batch of keyed rows to the sinks whose target is set.

`commit` makes a batch's outputs one: each sink's folder of the batch is replaced, and a
record of the batch is written last. Readers go by these records, so what a query that
stopped between two sinks has left is not seen until the batch has run again.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from netrill.config import FlowOptions
from netrill.operators import samples
from netrill.operators.topk import complete_conversation
from netrill.plans.sums import shape_sums
from netrill.plans.summaries import rank_shapes, to_summaries
from netrill.sinks import writers
from netrill.streaming.slots import read_slots, write_slots


def fan_out(
    rows: DataFrame,
    options: FlowOptions,
    batch_id: int = 0,
    records_path: str | None = None,
    panes_path: str | None = None,
) -> None:
    """Rank the rows once and write documents, records and samples.

    ``records_path`` takes the place of a topic. The ranked rows, at most K per
    parent and shape, are kept while the writers read them. With ``panes_path``
    batches bring new panes of earlier windows: each gets its number there.
    """
    ranked = rank_shapes(shape_sums(rows, rankable=complete_conversation()), options.top_k)
    kept = [ranked.withColumn("pane", F.lit(0)).persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        if panes_path:
            found = numbered(kept[0], panes_path, batch_id, options)
            kept.append(found.persist(StorageLevel.MEMORY_AND_DISK))
        ranked = kept[-1]
        summaries = to_summaries(ranked, options.fixed_window_size_ms, ["pane"])
        if options.documents_path:
            writers.write_documents(summaries, options.documents_path, options, batch_id)
        if options.destination_topic or records_path:
            writers.write_records(summaries, options, records_path, batch_id)
        if options.samples_path:
            chosen = samples.included(ranked, options)
            writers.write_samples(chosen, options.samples_path, options, batch_id)
    finally:
        for held in kept:
            held.unpersist()


def numbered(ranked: DataFrame, path: str, batch_id: int, options: FlowOptions) -> DataFrame:
    """Number each row among the batches that hold its series and window; notes this batch's.

    So the times of one series and number increase. Only the time slots of this batch's
    windows are read, and a batch that runs again finds the same earlier batches.
    """
    spark = ranked.sparkSession
    end = (F.col("window_start") + options.fixed_window_size_ms).alias("window_end")
    series = F.xxhash64(*samples.SERIES_COLUMNS).alias("series")
    check = F.crc32(F.to_json(F.struct(*samples.SERIES_COLUMNS)).cast("binary")).alias("series_check")
    keys = ["series", "series_check", "window_end"]
    own = ranked.select(series, check, end)
    write_slots(own, path, batch_id)
    first, last = own.agg(F.min("window_end"), F.max("window_end")).first()
    if first is None:
        return ranked
    earlier = read_slots(spark, own.schema, path, first, last, batch_id - 1)
    before = earlier.groupBy(*keys).agg(F.count_distinct("batch").cast("int").alias("before"))
    marked = ranked.drop("pane").select("*", series, check, end).join(before, keys, "left")
    return marked.withColumn("pane", F.coalesce("before", F.lit(0))).drop(*keys, "before")


COMMITS = "commits"


def commit(
    rows: DataFrame, options: FlowOptions, batch_id: int, folder: str, records_path: str | None = None
) -> None:
    """All sinks of a batch of panes, then the record that makes them count."""
    fan_out(rows, options, batch_id, records_path, os.path.join(folder, "series"))
    done = rows.sparkSession.range(1).select(F.lit(batch_id).cast("bigint").alias("committed"))
    done.write.mode("overwrite").parquet(os.path.join(folder, COMMITS, f"batch={batch_id}"))


def committed(spark: SparkSession, found: DataFrame, folder: str) -> DataFrame:
    """Rows of a sink, read with their ``batch``, that are of whole batches."""
    whole = spark.read.schema("committed bigint, batch bigint").parquet(os.path.join(folder, COMMITS))
    return found.join(whole.select("batch"), "batch", "left_semi")
