"""What a stream leaves out, kept with the reason: a second query over the same messages.

It has its own checkpoint and no state, so it can be stopped, started and repaired from
without touching the sums. What it holds and what the sums hold add up to what came in.
Rows too late for their window are known only where the window is; the pane sinks keep them.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from netrill.config import FlowOptions
from netrill.operators import windowing
from netrill.schema import FLOW_SCHEMA
from netrill.sources import kafka, protobuf
from netrill.streaming.windows import start

MALFORMED = "malformed"
#: Reasons for which a flow is left out as a whole.
WHOLE = (windowing.MISSING_EXPORTER, windowing.START_BEFORE_SHIFT, windowing.END_BEFORE_START, windowing.AHEAD_OF_CLOCK)


def left_out(decoded: DataFrame, options: FlowOptions) -> DataFrame:
    """reason, detail, payload, flow and dropped_windows of messages and flows that are left out.

    Of a malformed message the payload is kept, of a flow its record. A flow that loses only
    its first windows is in the sums with the others; ``dropped_windows`` says how many it lost.
    """
    read = F.col("decode_error").isNull()
    # One pass: a malformed message is a record without an exporter here.
    return windowing.quarantine(decoded, options).select(
        F.when(read, F.col("reason")).otherwise(F.lit(MALFORMED)).alias("reason"),
        F.col("decode_error").alias("detail"),
        F.col("payload"),
        F.when(read, F.struct(*FLOW_SCHEMA.names)).cast(FLOW_SCHEMA.simpleString()).alias("flow"),
        F.when(read, F.col("dropped_windows")).cast("bigint").alias("dropped_windows"),
    )


def start_quarantine(
    messages: DataFrame, options: FlowOptions, checkpoint: str, path: str, once: bool = True
) -> StreamingQuery:
    """Keep what is left out of a message stream below ``path``, by reason."""

    def write(batch: DataFrame, batch_id: int) -> None:
        found = left_out(protobuf.decode_flows(batch), options)
        target = os.path.join(path, f"batch={batch_id}")
        found.write.mode("overwrite").partitionBy("reason").parquet(target)

    return start(messages.select("value"), "append", write, checkpoint, once)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "false").parquet(path)


def counts(spark: SparkSession, path: str) -> DataFrame:
    """Messages and flows left out, by reason."""
    return read_quarantine(spark, path).groupBy("reason").agg(F.count("*").alias("n"))


def start_messages(
    spark: SparkSession, options: FlowOptions, checkpoint: str, path: str, folder: str | None = None, once: bool = True
) -> StreamingQuery:
    """The quarantine of the configured topic, or of message files."""
    return start_quarantine(kafka.message_stream(spark, options, folder), options, checkpoint, path, once)
