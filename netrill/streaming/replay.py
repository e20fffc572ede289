"""Running bounded inputs through streams, part by part."""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

Starter = Callable[[DataFrame], StreamingQuery]


def arrivals(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(os.path.join(folder, "arrivals"))


def replay(flows: DataFrame, parts: Sequence[str], folder: str, begin: Starter) -> int:
    """Let the flows arrive in parts, given as conditions; a new query continues after each.

    Every query starts from the checkpoint of the one before, as after a
    restart. Returns the id of the next batch.
    """
    spark = flows.sparkSession
    path = os.path.join(folder, "arrivals")
    following = 0
    for part in parts:
        flows.filter(part).write.mode("append").parquet(path)
        query = begin(arrivals(spark, folder, flows.schema))
        query.awaitTermination()
        done = [progress["batchId"] for progress in query.recentProgress]
        following = max([following, *[number + 1 for number in done]])
    return following


def run_until_quiet(query: StreamingQuery, written: list[int], delay_s: float) -> None:
    """Wait until nothing more is read or written, then stop.

    For operators with processing-time timers, which never run out of work:
    they are done when several batches in a row, spanning more than the
    operator's delay, neither read nor wrote. ``written`` gets one entry per
    batch, its number of rows. There is no time limit: a result is whole or an error.
    """
    last_busy, calm = time.time(), 3
    while query.isActive:
        time.sleep(0.2)
        recent = query.recentProgress[-calm:]
        idle = len(recent) == calm and not any(p["numInputRows"] for p in recent)
        if not idle or any(written[-calm:]):
            last_busy = time.time()
        elif time.time() - last_busy > delay_s:
            break
    while query.isActive and query.status["isTriggerActive"]:
        time.sleep(0.02)
    query.stop()
    if query.exception() is not None:
        raise query.exception()
