"""Writers of summaries and samples.

Each writes one folder per batch and overwrites it, so a batch that runs again
after a failure leaves the same files.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from netrill.config import FlowOptions
from netrill.functions import metrics
from netrill.operators import documents, samples
from netrill.sources.kafka import producer_options


def batch_folder(path: str, batch_id: int) -> str:
    return os.path.join(path, f"batch={batch_id}")


def write_documents(
    summaries: DataFrame, path: str, options: FlowOptions, batch_id: int = 0
) -> None:
    """JSON lines, one folder per index."""
    found = documents.documents(summaries, options)
    (
        found.select("index", F.concat(F.lit('{"_id":"'), "id", F.lit('",'), F.substring("value", F.lit(2), F.length("value"))).alias("value"))
        .write.mode("overwrite")
        .partitionBy("index")
        .text(batch_folder(path, batch_id))
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """All documents of a folder; of equal ids the last batch wins."""
    lines = spark.read.text(path)
    identified = documents.parse_documents(
        lines.withColumn("id", F.get_json_object("value", "$._id"))
    )
    others = [name for name in identified.columns if name != "id"]
    newest = F.max_by(F.struct(*others), "batch").alias("doc")
    return identified.groupBy("id").agg(newest).select("id", "doc.*").drop("batch")


def write_records(
    summaries: DataFrame, options: FlowOptions, path: str | None = None, batch_id: int = 0
) -> None:
    """The same JSON as value-only records, to a topic or to text files."""
    values = documents.documents(summaries, options).select("value")
    if path is None:
        values.write.format("kafka").options(**producer_options(options)).save()
    else:
        values.write.mode("overwrite").text(batch_folder(path, batch_id))


def in_series_order(found: DataFrame) -> DataFrame:
    """All samples of a series in one task, by time."""
    return found.repartition("series").sortWithinPartitions("series", "ts_ms")


def write_samples(
    ranked: DataFrame,
    path: str,
    options: FlowOptions,
    batch_id: int = 0,
    fixed_labels: Mapping[str, str] | None = None,
) -> None:
    """Samples of rows that carry a ``pane``, ordered and cut into batches."""
    labels = {**dict(options.fixed_labels), **(fixed_labels or {})}
    found = samples.to_samples(ranked, options.fixed_window_size_ms, labels)
    cut = cut_batches(with_series(found), options)
    cut.write.mode("overwrite").parquet(batch_folder(path, batch_id))


def with_series(found: DataFrame) -> DataFrame:
    return found.select(
        samples.label_text(F.col("labels")).alias("series"),
        "labels",
        "ts_ms",
        "value",
        metrics.series_bytes(F.col("labels"), F.col("ts_ms"), F.col("value")).alias("size"),
    )


BATCHED_COLUMNS = "series string, labels map<string,string>, ts_ms bigint, value double, size int"


def cut_batches(found: DataFrame, options: FlowOptions) -> DataFrame:
    """Number the write batches of each task's ordered samples.

    A batch closes before the sample that would make it too long or too large.
    The cut depends on all samples before it, so it walks each task's Arrow
    batches, jumping from cut to cut; it keeps only the open batch's size.
    """
    most, largest = options.metric_max_batch_size, options.metric_max_batch_bytes

    def cut(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer = TaskContext.get().partitionId()
        batch, held, held_bytes, written = 0, 0, 0, 0
        for table in tables:
            sizes = np.asarray(table.column("size"), dtype=np.int64)
            ends = np.cumsum(sizes)
            numbers = np.empty(len(sizes), dtype=np.int64)
            start, used = 0, 0
            while start < len(sizes):
                by_bytes = int(np.searchsorted(ends, used + largest - held_bytes, side="right"))
                stop = min(by_bytes, start + most - held)
                if stop <= start:
                    if held:
                        batch, held, held_bytes = batch + 1, 0, 0
                        continue
                    stop = start + 1
                numbers[start:stop] = batch
                held += stop - start
                held_bytes += int(ends[stop - 1]) - used
                start, used = stop, int(ends[stop - 1])
            size = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    *table.columns,
                    pa.array(np.full(size, writer, dtype=np.int32)),
                    pa.array(numbers),
                    pa.array(np.arange(written, written + size, dtype=np.int64)),
                ],
                names=[*table.schema.names, "writer", "batch", "written"],
            )
            written += size

    ordered = in_series_order(found).select("series", "labels", "ts_ms", "value", "size")
    return ordered.mapInArrow(cut, f"{BATCHED_COLUMNS}, writer int, batch bigint, written bigint")
