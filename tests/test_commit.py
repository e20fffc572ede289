"""Sinks of one batch: all or nothing, each pane a document and a sample index of its own."""

import pytest
from pyspark.sql import functions as F

from helpers import flow, flows, window_start
from netrill import FlowOptions
from netrill.operators import documents
from netrill.plans import groupings as G
from netrill.sinks import writers
from netrill.sources import protobuf
from netrill.streaming import quarantine, replay, sinks, timed, windows

MINUTE = 60_000
S = window_start(99, MINUTE, 1_500_000_000_000)


def arrivals(spark):
    for at, start, size in ((0, S, 1), (50, S + 20 * MINUTE, 2), (100, S, 4)):
        yield flows(spark, [flow(start, start + 100, size)]).withColumn(timed.ARRIVED, F.lit(at).cast("bigint"))


def test_a_batch_that_stopped_between_sinks_counts_once(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    options = FlowOptions(
        allowed_lateness_ms=60 * MINUTE, late_processing_delay_ms=10,
        documents_path=f"{base}/documents", samples_path=f"{base}/samples", fixed_labels=(("my run", "a"),),
    )

    def begin(stream):
        joined = windows.with_closing(stream, base)
        return timed.start_sinks(joined, options, f"{base}/checkpoint", base, f"{base}/records")

    given = list(arrivals(spark))
    write, failures = writers.write_samples, [True]

    def failing(*args, **more):
        if failures:
            raise RuntimeError("stopped between two sinks")
        return write(*args, **more)

    monkeypatch.setattr(writers, "write_samples", failing)
    with pytest.raises(Exception, match="stopped between two sinks"):
        replay.replay(given[0], ["true"], base, begin)
    failures.clear()
    for part in given[1:]:
        replay.replay(part, ["true"], base, begin)
    windows.write_closing(given[0], base, S + 20 * MINUTE, options)
    begin(replay.arrivals(spark, base, given[0].schema)).awaitTermination()

    lines = sinks.committed(spark, spark.read.text(f"{base}/documents"), base)
    found = documents.parse_documents(lines.withColumn("id", F.get_json_object("value", "$._id")))
    totals = found.filter(F.col("grouped_by") == G.INTERFACE).collect()
    assert sorted((r.range_start - S, r.bytes_total) for r in totals) == [(0, 1), (0, 4), (20 * MINUTE, 2)]
    assert len({r.id for r in totals}) == 3
    samples = sinks.committed(spark, spark.read.parquet(f"{base}/samples"), base)
    labels = F.col("labels")
    own = samples.filter((labels["__name__"] == G.INTERFACE) & (labels["direction"] == "in"))
    got = own.select("ts_ms", labels["pane"].alias("pane"), "value", labels["my_run"].alias("run")).collect()
    assert sorted((r.ts_ms - S + 1, r.pane, r.value, r.run) for r in got) == [
        (MINUTE, "0", 1.0, "a"), (MINUTE, "1", 4.0, "a"), (21 * MINUTE, "0", 2.0, "a"),
    ]
    assert spark.read.text(f"{base}/records").count() == found.count()


def test_what_is_left_out_is_kept(spark, tmp_path):
    base = str(tmp_path)
    good = flow(S, S + 100, 1)
    bad = [flow(S, S + 100, 2, node_id=None), flow(S, S - 100, 3), flow(S - 40 * MINUTE, S, 5), flow(5, 6, 1, node_id=3)]
    messages = protobuf.encode_flows(flows(spark, [good, *bad]))
    broken = spark.createDataFrame([(bytearray(b"\x7f\x01"),)], "value binary")
    messages.unionByName(broken).write.parquet(f"{base}/messages")
    options = FlowOptions()
    begin = lambda: quarantine.start_messages(spark, options, f"{base}/checkpoint", f"{base}/out", f"{base}/messages")
    begin().awaitTermination()
    # Started again there is nothing new.
    begin().awaitTermination()
    rows = quarantine.read_quarantine(spark, f"{base}/out").collect()
    assert {r.reason: r.flow and r.flow.num_bytes for r in rows} == {
        "malformed": None, "missing_exporter": 2, "end_before_start": 3, "reaches_back": 5, "start_before_shift": 1,
    }
    assert [bytes(r.payload) for r in rows if r.reason == "malformed"] == [b"\x7f\x01"]
    assert [r.dropped_windows > 0 for r in rows if r.reason == "reaches_back"] == [True]
