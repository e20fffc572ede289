"""Counters of a running stream, and the versions of an upsert store."""

import os

from pyspark.sql import functions as F

from helpers import flow, flows, window_start
from netrill import FlowOptions, build_summaries
from netrill.schema import SUMMARY_COLUMNS
from netrill.streaming import counters, replay, windows

MINUTE = 60_000
S = window_start(99, MINUTE, 1_500_000_000_000)
OPTIONS = FlowOptions(allowed_lateness_ms=0, max_flow_duration_ms=2 * MINUTE)


def rows_of(frame):
    return sorted(map(tuple, frame.select(*SUMMARY_COLUMNS).collect()), key=str)


def test_counters_of_each_batch(spark, tmp_path):
    folder, seen, runs = str(tmp_path), [], []
    first = [flow(S, S + 2 * MINUTE - 1, 10), flow(S + 5, S, 1), flow(S, S + 5, 1, node_id=None)]
    first += [flow(S, S + 30 * MINUTE - 1, 7)]
    second = [flow(S, S + 9, 3)]

    def begin(stream):
        joined = windows.with_closing(stream, folder)
        writer = lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")
        runs.append(windows.start_final(joined, OPTIONS, f"{folder}/checkpoint", writer))
        return runs[-1]

    with counters.StreamCounters(keep=50, sink=seen.append).of(spark) as found:
        for records in (first, second):
            replay.replay(flows(spark, records), ["true"], folder, begin)
        windows.write_closing(flows(spark, first), folder, S + 30 * MINUTE, OPTIONS)
        begin(replay.arrivals(spark, folder, flows(spark, first).schema)).awaitTermination()
        for query in runs:
            found.wait(query)
        rows = [r.asDict() for r in found.table(spark).collect()]
    assert len(seen) == len(rows)
    by_run = [[r for r in rows if r["run"] == str(query.runId)] for query in runs]
    sums = [{n: sum(r[n] for r in run) for n in (*counters.COUNTED[:-1], "late_keys")} for run in by_run]
    assert [(s["flows_read"], s["missing_exporter"], s["end_before_start"]) for s in sums] == [
        (4, 1, 1), (1, 0, 0), (0, 0, 0),
    ]
    # Of the long flow's 30 windows those that start over two minutes before its end are left out.
    assert sums[0]["in_window"] + sums[0]["reaches_back"] == 2 + 30 and sums[0]["in_window"] < 6
    # The second part's one flow is behind the watermark of the first.
    assert [s["late_keys"] for s in sums] == [0, 1, 0]
    newest = [r for r in by_run[0] if r["newest_switched"] is not None]
    assert [r["newest_switched"] for r in newest] == [S + 30 * MINUTE - 1]
    assert newest[0]["drift_ms"] == newest[0]["newest_switched"] - newest[0]["at_ms"]
    assert all(r["newest_switched"] is None for r in by_run[2])


def read_sizes(path):
    return {
        folder: sum(os.path.getsize(os.path.join(folder, name)) for name in names)
        for folder, _, names in os.walk(path)
        if names
    }


def test_a_slot_has_one_version_and_the_one_before(spark, tmp_path):
    """What a trigger reads does not grow with the triggers before it."""
    folder, options = str(tmp_path), FlowOptions()
    leaf, every = None, []
    for batch in range(6):
        every += [flow(S, S + 9, 1 + batch), flow(S + 20 * MINUTE, S + 20 * MINUTE + 9, 5, output_snmp_ifindex=batch)]
        if batch in (2, 3):
            every.append(flow(S, S + 9, 2, direction="EGRESS"))  # an interface without a number
        given = windows.stream_rows(flows(spark, every), options)
        leaf = windows.leaf_state(given)
        windows.upsert_batch(leaf, batch, folder, options)
        if batch == 4:
            before = rows_of(windows.current_summaries(spark, folder))
            windows.upsert_batch(leaf, batch, folder, options)
            assert rows_of(windows.current_summaries(spark, folder)) == before
        for kind in ("leaf", "summaries"):
            for slot in os.listdir(f"{folder}/{kind}"):
                if slot.startswith("slot="):
                    versions = {n for n in os.listdir(f"{folder}/{kind}/{slot}") if n.startswith("batch=")}
                    assert versions <= {f"batch={batch}", f"batch={batch - 1}"}
    assert rows_of(windows.current_summaries(spark, folder)) == rows_of(build_summaries(flows(spark, every), options))


def test_an_upsert_touches_only_its_slots(spark, tmp_path):
    folder, options = str(tmp_path), FlowOptions()
    far = flow(S + 60 * MINUTE, S + 60 * MINUTE + 9, 5)
    parts = [[flow(S, S + 9, 1), far], [flow(S + 1, S + 9, 4, application="web")]]
    windows.upsert_batch(windows.leaf_state(windows.stream_rows(flows(spark, parts[0]), options)), 0, folder, options)
    untouched = {k: v for k, v in read_sizes(f"{folder}/leaf").items()}
    windows.upsert_batch(windows.leaf_state(windows.stream_rows(flows(spark, parts[1]), options)), 1, folder, options)
    after = read_sizes(f"{folder}/leaf")
    assert sum(k.endswith("batch=1") for k in after) == 1
    assert all(after.get(k) == v for k, v in untouched.items())
    got = windows.current_summaries(spark, folder)
    assert rows_of(got) == rows_of(build_summaries(flows(spark, parts[0] + parts[1]), options))
    assert got.filter(F.col("range_start") > S + 30 * MINUTE).count() > 0
