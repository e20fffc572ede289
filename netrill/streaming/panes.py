"""Discarding panes: every pane of a window holds only its new rows.

Each micro-batch's rows are merged to leaf rows and stored, one folder per
batch. The event-time watermark is the newest ``last_switched`` seen, never
ahead of the clock, minus the longest input delay. When it passes a window's
end, the window's stored rows become its on-time pane; rows that come later
become late panes in their own batch, until the allowed lateness is over. With
early panes on, rows are handed on in their own batch and not held.

Panes carry a ``timing``. Readers add the panes of a window up. A batch that
runs again replaces its own folders and finds the watermark of the one before.
"""

from __future__ import annotations

import os
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from netrill.config import FlowOptions
from netrill.operators.aggregate import merge_by
from netrill.operators.windowing import window_rows
from netrill.plans import groupings as G
from netrill.plans.sums import KEY_COLUMNS
from netrill.plans.summaries import summaries_of_rows
from netrill.streaming.slots import read_slots, slots_of_several, write_slots
from netrill.streaming.windows import start

EARLY, ON_TIME, LATE = "early", "on_time", "late"
BEFORE_ALL, AFTER_ALL = -(1 << 62), 1 << 62
LEAF = ["window_end", *KEY_COLUMNS]


def _merged(rows: DataFrame) -> DataFrame:
    return merge_by(rows, LEAF, ["hostname", "hostname2"])


def _progress(spark: SparkSession, path: str, batch_id: int) -> tuple[int, int]:
    """Newest event time and watermark after the batch before this one."""
    if batch_id == 0:
        return BEFORE_ALL, BEFORE_ALL
    folder = os.path.join(path, "progress", f"of={batch_id - 1}")
    last = spark.read.schema("newest bigint, watermark bigint").parquet(folder).first()
    return last.newest, last.watermark


def _note(spark: SparkSession, path: str, batch_id: int, newest: int, watermark: int) -> None:
    spark.range(1).select(
        F.lit(newest).cast("bigint").alias("newest"),
        F.lit(watermark).cast("bigint").alias("watermark"),
    ).write.mode("overwrite").parquet(os.path.join(path, "progress", f"of={batch_id}"))


def _write(panes: DataFrame, path: str, batch_id: int) -> None:
    panes.write.mode("overwrite").parquet(os.path.join(path, "panes", f"batch={batch_id}"))


def _held(
    spark: SparkSession, schema: T.StructType, path: str, before: int, until: int, batch_id: int
) -> DataFrame:
    """Rows stored for windows that end after ``before``, at the latest ``until``."""
    stored = read_slots(spark, schema, os.path.join(path, "held"), before, until, batch_id)
    end = F.col("window_end")
    return stored.filter((end > before) & (end <= until))


def _held_merged(
    spark: SparkSession, schema: T.StructType, path: str, before: int, until: int, batch_id: int
) -> DataFrame:
    """The same rows, one per window and key.

    A batch's own rows are so from the start, and a window lies in one slot. So only the slots
    that several batches have written are merged.
    """
    rows = _held(spark, schema, path, before, until, batch_id)
    several = F.col("slot").isin(slots_of_several(spark, os.path.join(path, "held"), batch_id))
    merged = _merged(rows.filter(several))
    return merged.unionByName(rows.filter(~several).select(*merged.columns))


def pane_batch(flows: DataFrame, batch_id: int, path: str, options: FlowOptions) -> None:
    """One micro-batch of flow records."""
    spark = flows.sparkSession
    newest, before = _progress(spark, path, batch_id)
    seen, span = Observation(), Observation()
    observed = flows.observe(seen, F.max("last_switched").alias("newest"))
    rows = _merged(window_rows(observed, options))
    schema = T.StructType.fromJson(rows.schema.jsonValue())
    ends = [F.min("window_end").alias("first"), F.max("window_end").alias("last")]
    write_slots(rows.observe(span, *ends), os.path.join(path, "held"), batch_id)
    newest = max(newest, seen.get["newest"] or BEFORE_ALL)
    now = int(time.time() * 1000)
    after = max(before, min(newest, now) - options.default_max_input_delay_ms)

    first, last = span.get["first"] or 0, span.get["last"] or 0
    arrived = _held(spark, schema, path, first - 1, last, batch_id).filter(
        F.col("batch") == batch_id
    )
    end = F.col("window_end")
    late = arrived.filter((end <= before) & (end + options.allowed_lateness_ms > before))
    if options.early_processing_delay_ms:
        on_time = arrived.filter((end > before) & (end <= after)).select(*schema.names)
        early = arrived.filter(end > after).withColumn("timing", F.lit(EARLY))
    else:
        on_time = _held_merged(spark, schema, path, before, after, batch_id)
        early = None
    panes = on_time.withColumn("timing", F.lit(ON_TIME)).unionByName(
        late.select(*schema.names).withColumn("timing", F.lit(LATE))
    )
    if early is not None:
        panes = panes.unionByName(early.select(*panes.columns))
    _write(panes, path, batch_id)
    _note(spark, path, batch_id, newest, after)


def drain(spark: SparkSession, path: str, batch_id: int, options: FlowOptions) -> None:
    """After a bounded input: the windows still held become on-time panes."""
    if options.early_processing_delay_ms:
        return
    _, before = _progress(spark, path, batch_id)
    held_path = os.path.join(path, "held")
    schema = T.StructType(
        [f for f in spark.read.parquet(held_path).schema if f.name not in ("slot", "batch")]
    )
    rows = _held_merged(spark, schema, path, before, AFTER_ALL, batch_id)
    _write(rows.withColumn("timing", F.lit(ON_TIME)), path, batch_id)
    _note(spark, path, batch_id, AFTER_ALL, AFTER_ALL)


def start_panes(
    flows: DataFrame, options: FlowOptions, checkpoint: str, path: str, once: bool = True
) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        pane_batch(batch, batch_id, path, options)

    return start(flows, "append", write, checkpoint, once)


def read_panes(spark: SparkSession, path: str) -> DataFrame:
    """Leaf panes with their ``timing`` and ``batch``."""
    return spark.read.parquet(os.path.join(path, "panes"))


def pane_summaries(
    panes: DataFrame, options: FlowOptions, timing: str, shapes: Sequence[str] = G.EMITTED
) -> DataFrame:
    """Summaries of one batch's panes of one timing, ranked inside the pane."""
    return summaries_of_rows(panes.filter(F.col("timing") == timing), options, shapes)
