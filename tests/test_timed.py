"""Panes and held values by their delays, on a stream whose records bring their time of arrival."""

import time

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from helpers import flow, flows, window_start
from netrill import FlowOptions
from netrill.operators import reducers
from netrill.streaming import replay, timed, windows

MINUTE = 60_000
S = window_start(99, MINUTE, 1_500_000_000_000)
OPTIONS = FlowOptions(allowed_lateness_ms=60 * MINUTE, late_processing_delay_ms=50)


def arrivals(spark, parts):
    """(time of arrival, [(start, bytes)]) as flows with the arrival column."""
    return [
        flows(spark, [flow(s, s + 100, size) for s, size in records]).withColumn(timed.ARRIVED, F.lit(at).cast("bigint"))
        for at, records in parts
    ]


def run(spark, folder, parts, options, drain=True, rows_of=None):
    """Panes of all parts, each a restarted query, as (start - S, timing, pane, rows, bytes)."""
    frames = arrivals(spark, parts)

    def begin(stream):
        joined = windows.with_closing(stream, folder)
        found = timed.timed_panes(timed.timed_rows(joined, options), options)

        def write(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

        return timed.start_timed(found, write, f"{folder}/checkpoint")

    for frame in frames:
        replay.replay(frame, ["true"], folder, begin)
    if drain:
        newest = max(s for _, records in parts for s, _ in records)
        windows.write_closing(frames[0], folder, newest, options)
        begin(replay.arrivals(spark, folder, frames[0].schema)).awaitTermination()
    found = spark.read.parquet(f"{folder}/out").collect()
    return sorted((r.window_end - MINUTE - S, r.pane, r.timing, r.rows, r.bytes_in) for r in found)


LATE = [
    (0, [(S, 1), (S, 2), (S + 20 * MINUTE, 10)]),
    (100, [(S, 4)]),
    (130, [(S, 8)]),
    (200, [(S, 16), (S - 24 * 60 * MINUTE, 5)]),
    (210, [(S, 32)]),
]
# The flow of the day before is behind Spark's own watermark, which keeps no such rows.
CASES = {
    # On time when the second part moves the clock on; 100 and 130 are one pane, so are 200 and 210.
    50: [(0, 0, "on_time", 2, 3), (0, 1, "late", 2, 12), (0, 2, "late", 2, 48), (20 * MINUTE, 0, "on_time", 1, 10)],
    20: [
        (0, 0, "on_time", 2, 3), (0, 1, "late", 1, 4), (0, 2, "late", 1, 8), (0, 3, "late", 2, 48),
        (20 * MINUTE, 0, "on_time", 1, 10),
    ],
    10**6: [(0, 0, "on_time", 2, 3), (0, 1, "late", 4, 60), (20 * MINUTE, 0, "on_time", 1, 10)],
}


@pytest.mark.parametrize("delay", list(CASES))
def test_late_panes_wait_for_their_delay(spark, tmp_path, delay):
    options = FlowOptions(allowed_lateness_ms=60 * MINUTE, late_processing_delay_ms=delay)
    assert run(spark, str(tmp_path), LATE, options) == CASES[delay]


def test_early_panes_and_expiry(spark, tmp_path):
    options = FlowOptions(allowed_lateness_ms=0, early_processing_delay_ms=100)
    parts = [(0, [(S, 1)]), (50, [(S, 2)]), (120, [(S, 4)]), (300, [(S, 8)]), (310, [(S + 10 * MINUTE, 1)]), (400, [(S, 9)])]
    assert run(spark, str(tmp_path), parts, options) == [
        (0, 0, "early", 2, 3), (0, 1, "early", 1, 4), (0, 2, "on_time", 1, 8),
        (10 * MINUTE, 0, "on_time", 1, 1),
    ]


def test_held_panes_are_flushed_when_the_window_is_over(spark, tmp_path):
    options = FlowOptions(allowed_lateness_ms=60 * MINUTE, late_processing_delay_ms=20, summary_accumulation_delay_ms=90)
    # The pane on time began at 0; at 130 it is due, and the late one fired then is held until 220.
    assert run(spark, str(tmp_path), LATE, options) == [
        (0, 0, "on_time", 2, 3), (0, 1, "late", 4, 60), (20 * MINUTE, 0, "on_time", 1, 10),
    ]


def test_too_late_rows_are_handed_on(spark, tmp_path):
    options = FlowOptions(allowed_lateness_ms=0)
    # Their window is over, but Spark's own watermark is a window behind.
    parts = [(0, [(S, 1), (S + 3 * MINUTE - 50, 2)]), (1, [(S, 4)]), (2, [(S + 59_000, 8)])]
    got = [row for row in run(spark, str(tmp_path), parts, options, drain=False) if row[0] == 0]
    assert got == [(0, -1, "too_late", 1, 4), (0, -1, "too_late", 1, 8), (0, 0, "on_time", 1, 1)]


def test_a_flow_ahead_of_the_clock_closes_nothing_and_stays(spark, tmp_path):
    far, recent = 4_000_000_000_000, window_start(99, MINUTE, int(time.time() * 1000))
    parts = [(0, [(recent, 1), (far, 7)]), (100, [(recent, 2)])]
    folder = str(tmp_path)
    assert run(spark, folder, parts, FlowOptions(), drain=False) == []
    frame = arrivals(spark, parts[:1])[0]
    windows.write_closing(frame, folder, far, FlowOptions())

    def begin(stream):
        joined = windows.with_closing(stream, folder)
        found = timed.timed_panes(timed.timed_rows(joined, FlowOptions()), FlowOptions())
        return timed.start_timed(found, lambda b, i: b.write.mode("overwrite").parquet(f"{folder}/out/batch={i}"), f"{folder}/checkpoint")

    begin(replay.arrivals(spark, folder, frame.schema)).awaitTermination()
    found = spark.read.parquet(f"{folder}/out").collect()
    assert sorted(r.bytes_in for r in found) == [3, 7]
    assert {r.node_id for r in found} == {99}


def test_delays_by_the_trigger_clock(spark, tmp_path):
    """Without arrival times the delay is real: a late pane is not out before it has passed."""
    folder = str(tmp_path)
    options = FlowOptions(allowed_lateness_ms=60 * MINUTE, late_processing_delay_ms=3000)

    def arrive(at, size):
        begun = time.time()
        frame = flows(spark, [flow(at, at + 100, size)])

        def begin(stream):
            found = timed.timed_panes(timed.timed_rows(stream, options), options)
            return timed.start_timed(found, lambda b, i: b.write.mode("overwrite").parquet(f"{folder}/out/batch={i}"), f"{folder}/checkpoint")

        replay.replay(frame, ["true"], folder, begin)
        return begun

    def panes():
        return sorted((r.pane, r.bytes_in) for r in spark.read.parquet(f"{folder}/out").filter(f"window_start = {S}").collect())

    arrive(S, 1)
    arrive(S + 20 * MINUTE, 2)
    arrive(S, 4)
    assert panes() == [(0, 1)]
    time.sleep(3)
    # The watermark has moved by more than the delay, so the pane's timer is due, and so is the pane.
    arrive(S + 21 * MINUTE, 8)
    assert panes() == [(0, 1), (1, 4)]


def test_one_reducer_for_batch_and_state(spark):
    longest = reducers.Reducer(
        (reducers.Field("a", T.LongType(), "max"), reducers.Field("b", T.StringType(), "min"), reducers.Field("c", T.LongType(), "sum"))
    )
    rows = [(1, "x", 5), (7, None, 6), (None, "c", None), (3, "d", 2)]
    schema = "a long, b string, c long"
    wanted = tuple(spark.createDataFrame(rows, schema).agg(*longest.columns()).first())
    frame = pd.DataFrame(rows, columns=["a", "b", "c"])
    assert longest.of_frame(frame) == wanted
    merged = longest.of_frame(frame[:1])
    for at in range(1, 4):
        merged = longest.merge(merged, longest.of_frame(frame[at : at + 1]))
    assert merged == wanted == (7, "c", 13)
