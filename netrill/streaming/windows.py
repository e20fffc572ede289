"""Closing windows on streams of keyed window rows.

Three contracts over the same rows, equal in their sum:

``final``   one row per key and window, once the allowed lateness is over
``upsert``  the current row per key and window after every trigger
``panes``   only what is new: an on-time pane, then late ones (``panes.py``)

The event time is the *window end*, because one flow feeds several windows. A
window end is at most one window later than the flow's last packet, which the
delays below make up for.

What the state of ``final`` and ``upsert`` keeps is the windows, one small row each. It says which
of them close, or take rows; the rows themselves are merged by batch and kept as files by time slot
(`slots`), where no executor has to hold them.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from netrill.config import FlowOptions
from netrill.operators import observe
from netrill.operators.aggregate import merge_by
from netrill.operators.windowing import window_rows
from netrill.plans.sums import KEY_COLUMNS
from netrill.plans.summaries import summaries_of_rows
from netrill.streaming.sinks import fan_out
from netrill.streaming.slots import (
    newest,
    read_batch,
    read_until,
    read_versions,
    remove_before,
    slots_of_several,
    write_slots,
    written_slots,
)

# Recommended for streams: state on disk, with changes only per checkpoint.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def closing_delay_ms(options: FlowOptions) -> int:
    """How far the largest window end must be past a window to close it."""
    return (
        options.default_max_input_delay_ms
        + options.allowed_lateness_ms
        + options.fixed_window_size_ms
    )


#: Set in records that only move the watermark on; see `write_closing`.
CLOSING = "closing"


def window_end_or_now(rows: DataFrame, options: FlowOptions) -> Column:
    """Event time of a window row: its window's end, but not past that of a record of now.

    So a record ahead of the clock is kept, and closes no window of others.
    """
    ahead = F.unix_millis(F.current_timestamp()) + F.lit(options.fixed_window_size_ms)
    return unless_closing(rows, F.col("window_end"), ahead)


def unless_closing(rows: DataFrame, time: Column, limit: Column) -> Column:
    """A time up to a limit, which closing records pass."""
    limited = F.least(time, limit)
    return F.when(F.col(CLOSING), time).otherwise(limited) if CLOSING in rows.columns else limited


Policy = Callable[[DataFrame, FlowOptions], Column]


def watermarked(rows: DataFrame, options: FlowOptions, policy: Policy = window_end_or_now) -> DataFrame:
    return rows.withColumn("closes_at", F.timestamp_millis(policy(rows, options))).withWatermark(
        "closes_at", f"{closing_delay_ms(options)} milliseconds"
    )


def without_closing(rows: DataFrame, event_time: str) -> DataFrame:
    """Rows that are data. The condition names the event time, or it would be pushed below the watermark."""
    if CLOSING not in rows.columns:
        return rows
    marked = F.coalesce(F.col(CLOSING), F.lit(False))
    return rows.filter(~marked | F.col(event_time).isNull()).drop(CLOSING)


def _rows(flows: DataFrame, options: FlowOptions, policy: Policy) -> DataFrame:
    keep = [CLOSING] if CLOSING in flows.columns else []
    return without_closing(watermarked(window_rows(flows, options, keep), options, policy), "closes_at")


def stream_rows(flows: DataFrame, options: FlowOptions, policy: Policy = window_end_or_now) -> DataFrame:
    """Window rows of a stream, with watermark."""
    live = ~F.coalesce(F.col(CLOSING), F.lit(False)) if CLOSING in flows.columns else F.lit(True)
    return _rows(observe.observed(flows, options, live), options, policy)


NAMES = ["hostname", "hostname2"]
LEAF = ["window_end", *KEY_COLUMNS]
WINDOW = ["closes_at", "window_end"]
#: Set in the rows that stand for a window; all other columns are null there.
IS_WINDOW = "is_window"


def leaf_state(rows: DataFrame) -> DataFrame:
    """Sums by the finest key. All else derives from them."""
    return merge_by(rows, ["closes_at", *LEAF], NAMES).drop("closes_at")


def rows_and_windows(flows: DataFrame, options: FlowOptions, policy: Policy = window_end_or_now) -> DataFrame:
    """The one stateful step: the rows of a batch as they are, and what the state says of their windows.

    In append mode these are the windows that close with the batch, in update mode those that take
    rows of it. Windows behind the watermark are neither.
    """
    rows = stream_rows(flows, options, policy).withColumn(IS_WINDOW, F.lit(False))
    kept = _rows(flows, options, policy).groupBy(*WINDOW).agg((F.count("*") > 0).alias(IS_WINDOW))
    return rows.unionByName(kept, allowMissingColumns=True)


def hold(batch: DataFrame, path: str, batch_id: int) -> tuple[DataFrame, DataFrame, list[int]]:
    """Merge and store the rows of a batch; its leaf rows, its windows, and the time slots of these."""
    spark = batch.sparkSession
    merged = merge_by(batch, [IS_WINDOW, "closes_at", *LEAF], NAMES)
    schema = T.StructType.fromJson(merged.schema.jsonValue())
    write_slots(merged, path, batch_id, kind=IS_WINDOW)
    rows = read_batch(spark, T.StructType(schema.fields[1:]), held_rows(path), batch_id)
    kept = read_batch(spark, T.StructType([schema[name] for name in WINDOW]), held_windows(path), batch_id)
    return rows.select(*schema.names[1:]), kept.select(*WINDOW), written_slots(spark, held_windows(path), batch_id)


def held_rows(path: str) -> str:
    return os.path.join(path, f"{IS_WINDOW}=false")


def held_windows(path: str) -> str:
    return os.path.join(path, f"{IS_WINDOW}=true")


BatchWriter = Callable[[DataFrame, int], None]


def start(
    result: DataFrame, mode: str, write: BatchWriter, checkpoint: str, once: bool = True
) -> StreamingQuery:
    writer = (
        result.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return writer.trigger(availableNow=True).start() if once else writer.start()


def start_final(
    flows: DataFrame, options: FlowOptions, checkpoint: str, write: BatchWriter, once: bool = True
) -> StreamingQuery:
    """Hand each window's leaf rows to ``write`` when the window closes.

    All keys of a window close in the same batch, so ranking a batch ranks
    whole windows. Rows of open windows are held beside the state.
    """
    held = os.path.join(checkpoint, "held")

    def close(batch: DataFrame, batch_id: int) -> None:
        write(closed_rows(batch, batch_id, held), batch_id)

    return start(rows_and_windows(flows, options), "append", close, checkpoint, once)


def closed_rows(batch: DataFrame, batch_id: int, path: str) -> DataFrame:
    """Store the rows of a batch; the leaf rows of the windows that close with it, of all batches.

    A batch's rows are one per window and key already, so only slots of several batches are merged.
    """
    spark = batch.sparkSession
    rows, closed, slots = hold(batch, path, batch_id)
    several = set(slots).intersection(slots_of_several(spark, held_rows(path), batch_id))
    parts = []
    for group in (several, set(slots) - several):
        found = read_until(spark, rows.schema, held_rows(path), group, batch_id)
        parts.append(found.join(closed, WINDOW, "left_semi").select(*rows.columns))
    return merge_by(parts[0], ["closes_at", *LEAF], NAMES).unionByName(parts[1]).drop("closes_at")


def sink_writer(options: FlowOptions, records_path: str | None = None) -> BatchWriter:
    return lambda batch, batch_id: fan_out(batch, options, batch_id, records_path)


def start_upsert(
    flows: DataFrame, options: FlowOptions, checkpoint: str, path: str, once: bool = True
) -> StreamingQuery:
    """Keep the summaries below ``path`` current after every trigger."""

    def write(batch: DataFrame, batch_id: int) -> None:
        held = os.path.join(path, "changed")
        rows, kept, slots = hold(batch, held, batch_id)
        changed = rows.join(kept, WINDOW, "left_semi").drop("closes_at")
        _upsert(changed, slots, batch_id, path, options, _added)
        for folder in (held_rows(held), held_windows(held)):
            remove_before(batch.sparkSession, folder, dict.fromkeys(slots, batch_id))

    return start(rows_and_windows(flows, options), "update", write, checkpoint, once)


TOUCHED = ["window_start", "node_id", "if_index"]
REBUILT = ["range_start", "node_id", "if_index"]


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Equal keys, missing ones included; the right side's are TOUCHED."""
    found = F.lit(True)
    for name, other in zip(names, TOUCHED, strict=True):
        found = found & left[name].eqNullSafe(right[other])
    return found


def _added(stored: DataFrame, changed: DataFrame) -> DataFrame:
    """Stored rows and those that came to them."""
    return merge_by(stored.unionByName(changed), LEAF, NAMES)


def _newest(stored: DataFrame, changed: DataFrame) -> DataFrame:
    """Changed rows in the place of stored ones."""
    values = [name for name in changed.columns if name not in KEY_COLUMNS]
    both = stored.withColumn("new", F.lit(0)).unionByName(changed.withColumn("new", F.lit(1)))
    newer = both.groupBy(*KEY_COLUMNS).agg(F.max_by(F.struct(*values), "new").alias("newest"))
    return newer.select(*KEY_COLUMNS, "newest.*")


def upsert_batch(batch: DataFrame, batch_id: int, path: str, options: FlowOptions) -> None:
    """Store changed leaf rows in the place of those of their key, then rebuild the interfaces they touch."""
    spark = batch.sparkSession
    changed_path = os.path.join(path, "changed")
    schema = T.StructType.fromJson(batch.schema.jsonValue())
    write_slots(batch, changed_path, batch_id)
    own = dict.fromkeys(written_slots(spark, changed_path, batch_id), batch_id)
    _upsert(read_versions(spark, schema, changed_path, own), list(own), batch_id, path, options, _newest)
    remove_before(spark, changed_path, own)


def _upsert(
    changed: DataFrame,
    slots: list[int],
    batch_id: int,
    path: str,
    options: FlowOptions,
    merged: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    """Merge changed leaf rows of some slots into the stored ones, then rebuild the interfaces they touch.

    Leaf rows and summaries are kept as one current version per time slot. A batch reads the
    versions of the slots it touches and writes them anew, so what it reads does not grow with
    the batches before it. A batch that runs again starts from the versions before its own.
    """
    if not slots:
        return
    spark = changed.sparkSession
    leaf_path, out_path = (os.path.join(path, name) for name in ("leaf", "summaries"))
    schema = T.StructType.fromJson(changed.schema.jsonValue())
    own = dict.fromkeys(slots, batch_id)
    earlier = newest(spark, leaf_path, slots, batch_id)
    stored = read_versions(spark, schema, leaf_path, earlier)
    write_slots(merged(stored, changed).select(*schema.names), leaf_path, batch_id)
    touched = changed.select(*TOUCHED).distinct()
    leaf = read_versions(spark, schema, leaf_path, own)
    rebuilt = summaries_of_rows(leaf.join(touched, _same(leaf, touched, TOUCHED), "left_semi"), options)
    kept = newest(spark, out_path, slots, batch_id)
    others = read_versions(spark, rebuilt.schema, out_path, kept)
    others = others.join(touched, _same(others, touched, REBUILT), "left_anti")
    write_slots(rebuilt.unionByName(others), out_path, batch_id, "range_end")
    # The versions this batch started from stay until the next one has written its own.
    remove_before(spark, leaf_path, earlier)
    remove_before(spark, out_path, kept)


def current_summaries(spark: SparkSession, path: str) -> DataFrame:
    """The summaries of the newest version of each slot."""
    stored = os.path.join(path, "summaries")
    versions = newest(spark, stored)
    return spark.read.parquet(*[f"{stored}/slot={slot}/batch={batch}" for slot, batch in sorted(versions.items())])


CLOSING_ROWS = "closing"


def with_closing(flows: DataFrame, folder: str) -> DataFrame:
    """The stream plus an initially empty folder of closing records.

    Open windows of a stream that ended stay open: nothing moves the watermark
    on. ``write_closing`` adds the record that does.
    """
    os_path = os.path.join(folder, CLOSING_ROWS)
    spark = flows.sparkSession
    schema = T.StructType([*flows.schema.fields, T.StructField(CLOSING, T.BooleanType())])
    if not _exists(spark, os_path):
        spark.createDataFrame([], schema).write.parquet(os_path)
    closing = spark.readStream.schema(schema).parquet(os_path)
    return flows.withColumn(CLOSING, F.lit(False)).unionByName(closing)


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def write_closing(flows: DataFrame, folder: str, newest_ms: int, options: FlowOptions) -> None:
    """Add a record that is late enough to close every window before it.

    It is marked, and left out once the watermark has seen it.
    """
    spark = flows.sparkSession
    at = newest_ms + closing_delay_ms(options) + 2 * options.fixed_window_size_ms
    known = {
        "node_id": 0,
        "num_bytes": 0,
        "delta_switched": at,
        "first_switched": at,
        "last_switched": at,
        CLOSING: True,
    }
    fields = [T.StructField(f.name, f.dataType) for f in flows.schema.fields]
    relaxed = T.StructType([*fields, T.StructField(CLOSING, T.BooleanType())])
    row = [known.get(name) for name in relaxed.names]
    spark.createDataFrame([row], relaxed).write.mode("append").parquet(
        os.path.join(folder, CLOSING_ROWS)
    )
