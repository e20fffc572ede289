"""Address ranges, messages, documents, samples and their batches."""

import json

import pytest
from pyspark.sql import functions as F

from helpers import flow, flows
from netrill import FlowOptions, build_summaries
from netrill.functions import metrics
from netrill.operators import documents, ranges, samples
from netrill.plans.sums import shape_sums
from netrill.plans.summaries import rank_shapes
from netrill.operators.topk import complete_conversation
from netrill.operators.windowing import window_rows
from netrill.sinks import writers
from netrill.sources import kafka, protobuf

T0 = 1_500_000_000_000
OPTIONS = FlowOptions()


def in_list(spark, text, addresses):
    rows = spark.createDataFrame([(a,) for a in addresses], "address string")
    found = ranges.in_ranges(rows, "address", ranges.configured_ranges(spark, text))
    return sorted(r.address for r in found.collect())


def test_membership_in_ranges(spark):
    given = ["0.0.0.7", "0.0.1.0", "10.0.0.5", "10.0.0.127", "10.0.0.128", "", "nonsense", "1.2.3.999"]
    assert in_list(spark, "0.0.0.0-0.0.0.255", given) == ["0.0.0.7"]
    assert in_list(spark, "10.0.0.5", given) == ["10.0.0.5"]
    assert in_list(spark, "10.0.0.0/25, 0.0.1.0", given) == ["0.0.1.0", "10.0.0.127", "10.0.0.5"]
    assert in_list(spark, "10.0.0.5/32", given) == ["10.0.0.5"]
    assert in_list(spark, "0.0.0.0/0", given) == [a for a in sorted(given) if a[:1].isdigit() and "999" not in a]
    six = ["2001:db8::1", "2001:db8:0:0:0:0:0:ff", "2001:db8:1::", "::ffff:10.0.0.5"]
    assert in_list(spark, "2001:db8::/48", six) == ["2001:db8:0:0:0:0:0:ff", "2001:db8::1"]
    assert in_list(spark, "10.0.0.0-10.0.0.9", six) == ["::ffff:10.0.0.5"]
    # Four-byte addresses come before all longer ones.
    assert in_list(spark, "10.0.0.0-::1", ["9.9.9.9", "11.0.0.1", "::", "::2"]) == ["11.0.0.1", "::"]


@pytest.mark.parametrize(
    "text",
    ["1.1.1.1-", "1-2-3", "10.0.0.0/8-10.0.0.9", "10.0.0.9-10.0.0.1", "example.com", "10.0.0.1/33",
     "10.0.0.1/x", "1.2.3.4-1.2.3.5-1.2.3.6"],
)
def test_bad_ranges_raise(spark, text):
    with pytest.raises(Exception, match="invalid address range"):
        ranges.configured_ranges(spark, text).collect()


def test_messages_round_trip_and_bad_ones_are_kept_apart(spark):
    given = flows(
        spark,
        [
            flow(T0, T0, 5, ecn=None, protocol=None, delta_switched=None, direction="EGRESS"),
            flow(T0, T0 + 1, 6, node_id=None, foreign_source=None, foreign_id=None),
        ],
    )
    messages = protobuf.encode_flows(given)
    broken = spark.createDataFrame([(bytearray(b"\xff\xff\xff"),), (None,)], "value binary")
    decoded = protobuf.decode_flows(messages.unionByName(broken)).cache()
    assert protobuf.rejected(decoded).count() == 2
    got = sorted(map(tuple, protobuf.accepted(decoded).collect()), key=str)
    wanted = given.withColumn("foreign_source", F.col("foreign_source"))
    assert got == sorted(map(tuple, wanted.collect()), key=str)
    decoded.unpersist()


def test_topic_settings(tmp_path):
    path = tmp_path / "client.properties"
    path.write_text("# comment\nsecurity.protocol=SSL\nbootstrap.servers: other:1\ngroup.id=x\n")
    options = FlowOptions(client_properties=str(path), bootstrap_servers="b:9", source_topic="t")
    found = kafka.consumer_options(options)
    assert found["kafka.security.protocol"] == "SSL"
    assert found["kafka.bootstrap.servers"] == "b:9"
    assert found["startingOffsets"] == "earliest"
    assert found["subscribe"] == "t" and "kafka.group.id" not in found
    assert kafka.producer_options(FlowOptions(destination_topic="d"))["topic"] == "d"


def test_documents(spark, tmp_path):
    summaries = build_summaries(flows(spark, [flow(T0, T0, 9, foreign_source="")]))
    found = documents.documents(summaries, FlowOptions(index_strategy="HOURLY")).collect()
    assert {row["index"] for row in found} == {"flow_summaries-2017-07-14-02"}
    total = next(json.loads(r.value) for r in found if '"EXPORTER_INTERFACE"' in r.value)
    assert total["exporter"] == {"node_id": 99} and "dscp" not in total
    assert total["@timestamp"] == total["range_end"] == 1500000007199
    path = str(tmp_path / "docs")
    writers.write_documents(summaries, path, OPTIONS, 1)
    writers.write_documents(summaries, path, OPTIONS, 1)
    writers.write_documents(summaries, path, OPTIONS, 2)
    assert writers.read_documents(spark, path).count() == summaries.count()


def test_index_names_ignore_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        at = spark.range(1).select(
            documents.index_name(F.lit(T0), FlowOptions(index_strategy="HOURLY")).alias("i")
        )
        assert at.first().i == "flow_summaries-2017-07-14-02"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ranked(spark, given):
    rows = window_rows(flows(spark, given), OPTIONS)
    return rank_shapes(shape_sums(rows, rankable=complete_conversation()), 10)


def test_sample_labels(spark):
    kept = samples.included(ranked(spark, [flow(T0, T0, 9)]), OPTIONS)
    found = samples.to_samples(kept.withColumn("pane", F.lit(0)), 60_000).filter("direction = 'in'")
    labels = {r.grouped_by: dict(r.labels) for r in found.collect()}
    common = {"pane": "0", "direction": "in"}
    assert labels == {
        "EXPORTER_INTERFACE": {
            "__name__": "EXPORTER_INTERFACE", "nodeId": "99", "ifIndex": "98", **common},
        "EXPORTER_INTERFACE_TOS": {
            "__name__": "EXPORTER_INTERFACE_TOS", "nodeId": "99", "ifIndex": "98", "dscp": "0",
            **common},
        "EXPORTER_INTERFACE_APPLICATION": {
            "__name__": "BY_APP_99_98", "application": "mail", **common},
        "EXPORTER_INTERFACE_TOS_APPLICATION": {
            "__name__": "BY_TOS_AND_APP_99_98", "dscp": "0", "application": "mail",
            **common},
    }
    assert {(r.ts_ms, r.value) for r in found.collect()} == {(1500000007198, 9.0)}


def test_sizes_match_the_wire_format(spark):
    def varint(n):
        return max(1, -(-n.bit_length() // 7))

    def framed(n):
        return 1 + varint(n) + n

    cases = [({"a": "b"}, T0, 1.5), ({"a": "x" * 300, "bb": ""}, 0, 0.0), ({}, 1, 2.0)]
    frame = spark.createDataFrame(cases, "labels map<string,string>, ts bigint, v double")
    got = frame.select(metrics.series_bytes(F.col("labels"), F.col("ts"), F.col("v")).alias("n"))
    want = []
    for labels, ts, value in cases:
        size = sum(framed(sum(framed(len(t)) if t else 0 for t in kv)) for kv in labels.items())
        want.append(size + framed((9 if value else 0) + (1 + varint(ts) if ts else 0)))
    assert [r.n for r in got.collect()] == want


def test_batches_keep_both_limits(spark):
    options = FlowOptions(metric_max_batch_size=7, metric_max_batch_bytes=100)
    sizes = [30, 30, 30, 30, 250, 5, 5, 5, 5, 5, 5, 5, 5, 60, 41]
    rows = [("s", {"a": "b"}, i, 1.0, size) for i, size in enumerate(sizes)]
    frame = spark.createDataFrame(
        rows, "series string, labels map<string,string>, ts_ms bigint, value double, size int"
    )
    found = writers.cut_batches(frame, options).orderBy("written").collect()
    batches = {}
    for row in found:
        batches.setdefault(row.batch, []).append(row.size)
    expected, held = [], []
    for size in sizes:
        if held and (len(held) >= 7 or sum(held) + size > 100):
            expected.append(held)
            held = []
        held = [*held, size]
    assert [batches[b] for b in sorted(batches)] == [*expected, held]
