"""Counters of running streams, batch by batch.

The flows report their counters as they pass (`operators.observe.observed`); Spark hands them
to a listener with each batch's progress. Nothing is read twice and no job is added.
"""

from __future__ import annotations

import threading
from collections import deque
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from netrill.operators import windowing
from netrill.operators.observe import FLOW_COUNTERS

COUNTED = (
    "flows_read",
    "in_window",
    windowing.REACHES_BACK,
    windowing.MISSING_EXPORTER,
    windowing.START_BEFORE_SHIFT,
    windowing.END_BEFORE_START,
    "newest_switched",
)
SCHEMA = (
    "query string, run string, batch bigint, at_ms bigint, "
    + ", ".join(f"{name} bigint" for name in COUNTED)
    + ", drift_ms bigint, late_keys bigint, state_rows bigint"
)


def counters_of(progress) -> tuple:
    """One row of SCHEMA from the progress of a batch.

    ``drift_ms`` is how far the newest flow is ahead of the trigger's clock, negative if behind.
    ``late_keys`` are partial sums that came behind the watermark and were dropped.
    """
    found = progress.observedMetrics.get(FLOW_COUNTERS)
    counted = found.asDict() if found is not None else {}
    at = int(datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")).timestamp() * 1000)
    last = counted.get("newest_switched")
    operators = progress.stateOperators
    return (
        str(progress.id),
        str(progress.runId),
        progress.batchId,
        at,
        *[counted.get(name, None if name == "newest_switched" else 0) for name in COUNTED],
        None if last is None else last - at,
        sum(operator.numRowsDroppedByWatermark for operator in operators),
        sum(operator.numRowsTotal for operator in operators),
    )


class StreamCounters(StreamingQueryListener):
    """Collects the counters of the last ``keep`` batches, and hands each on to ``sink``.

    Use as ``with StreamCounters().of(spark) as counters``. A sink is a function of a row, for
    example one that sets the gauges of a monitoring library.
    """

    def __init__(self, keep: int = 1000, sink: Callable[[tuple], None] | None = None) -> None:
        self.rows: deque[tuple] = deque(maxlen=keep)
        self.sink = sink
        self._ended: dict[str, bool] = {}
        self._changed = threading.Condition()
        self._spark: SparkSession | None = None

    def of(self, spark: SparkSession) -> StreamCounters:
        self._spark = spark
        return self

    def __enter__(self) -> StreamCounters:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = counters_of(event.progress)
        self.rows.append(row)
        if self.sink is not None:
            self.sink(row)

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended[str(event.runId)] = True
            self._changed.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all of a stopped query's progress has arrived."""
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no end of query {query.runId} after {seconds} s")

    def table(self, spark: SparkSession) -> DataFrame:
        """The collected rows, one per batch."""
        return spark.createDataFrame(list(self.rows), SCHEMA)
