"""Golden rows of small scripted inputs."""

from pyspark.sql import functions as F

from helpers import flow, flows, window_start
from netrill import FlowOptions, build_summaries
from netrill.operators import windowing
from netrill.plans import groupings as G

T0 = 1_500_000_000_000


def collected(frame, *columns):
    return sorted(tuple(row) for row in frame.select(*columns).collect())


def test_known_window(spark):
    start = window_start(99, 60_000, T0)
    assert (start, start + 60_000) == (1499999947199, 1500000007199)
    rows = windowing.window_rows(flows(spark, [flow(T0, T0, 1)]), FlowOptions())
    assert collected(rows, "window_start", "window_end") == [(1499999947199, 1500000007199)]


def test_bytes_are_split_over_windows(spark):
    options = FlowOptions(fixed_window_size_ms=10_000)
    s = window_start(99, 10_000, T0)

    def seconds(a, b, size, name):
        return flow(s + a * 1000, s + b * 1000 - 1, size, foreign_id=name)

    given = [
        seconds(17, 32, 1500, "app-a"),
        seconds(10, 32, 4400, "app-b"),
        seconds(10, 40, 9000, "app-c"),
        seconds(12, 37, 10000, "app-d"),
        seconds(23, 27, 2000, "app-e"),
    ]
    found = build_summaries(flows(spark, given), options, [G.INTERFACE])
    at = ((F.col("range_start") - s) / 1000).cast("int")
    assert collected(found, "foreign_id", at, "bytes_total") == [
        ("app-a", 10, 300), ("app-a", 20, 1000), ("app-a", 30, 200),
        ("app-b", 10, 2000), ("app-b", 20, 2000), ("app-b", 30, 400),
        ("app-c", 10, 3000), ("app-c", 20, 3000), ("app-c", 30, 3000),
        ("app-d", 10, 3200), ("app-d", 20, 4000), ("app-d", 30, 2800),
        ("app-e", 20, 2000),
    ]


def test_host_names_and_all_shapes(spark):
    s = window_start(99, 60_000, T0)
    given = [
        flow(s, s + 100, 42, src_hostname="alder.lan",
             dst_hostname="birch.lan"),
        flow(s + 1000, s + 1100, 23, src_address="10.0.0.2", dst_address="10.0.0.3",
             src_hostname="cedar.lan"),
        flow(s + 2000, s + 2100, 1337, dst_address="10.0.0.3",
             dst_hostname="dogwood.lan"),
    ]
    found = build_summaries(flows(spark, given)).cache()
    assert found.count() == 16
    assert found.filter("bytes_egress <> 0 or congestion_encountered or not non_ect").count() == 0
    hosts = [
        ("10.0.0.1", "alder.lan", 1379),
        ("10.0.0.2", "birch.lan", 65),
        ("10.0.0.3", "dogwood.lan", 1360),
    ]
    talks = [
        ('["",6,"10.0.0.1","10.0.0.2","mail"]', 42),
        ('["",6,"10.0.0.1","10.0.0.3","mail"]', 1337),
        ('["",6,"10.0.0.2","10.0.0.3","mail"]', 23),
    ]
    for shape in (G.HOST, G.TOS_HOST):
        rows = found.filter(F.col("grouped_by") == shape)
        assert collected(rows, "host_address", "host_name", "bytes_total") == hosts
    for shape in (G.CONVERSATION, G.TOS_CONVERSATION):
        rows = found.filter(F.col("grouped_by") == shape)
        assert collected(rows, "conversation_key", "bytes_total") == talks
    for shape in (G.INTERFACE, G.TOS, G.APPLICATION, G.TOS_APPLICATION):
        rows = found.filter(F.col("grouped_by") == shape)
        assert collected(rows, "bytes_total") == [(1402,)]
    keys = collected(found.filter(F.col("grouped_by") == G.TOS_APPLICATION), "grouped_by_key")
    assert keys == [("plant:edge-7-98-0-mail",)]
    found.unpersist()


def test_by_dscp(spark):
    given = [flow(T0, T0 + 100, 11), flow(T0 + 100, T0 + 150, 17, dscp=3)]
    found = build_summaries(flows(spark, given)).cache()
    expected = {
        G.INTERFACE: [28], G.APPLICATION: [28], G.CONVERSATION: [28], G.HOST: [28, 28],
        G.TOS: [11, 17], G.TOS_APPLICATION: [11, 17], G.TOS_CONVERSATION: [11, 17],
        G.TOS_HOST: [11, 11, 17, 17],
    }
    for shape, amounts in expected.items():
        rows = found.filter(F.col("grouped_by") == shape)
        assert [a for a, in collected(rows, "bytes_total")] == amounts
    assert found.count() == 15
    found.unpersist()


def test_ties_go_by_key_and_k_above_the_group_limit(spark):
    given = [flow(T0, T0, 5, application=f"app{i:04d}") for i in range(1200)]
    few = build_summaries(flows(spark, given), FlowOptions(top_k=3), [G.APPLICATION])
    assert collected(few, "ranking", "application") == [
        (1, "app0000"), (2, "app0001"), (3, "app0002"),
    ]
    many = build_summaries(flows(spark, given), FlowOptions(top_k=1100), [G.APPLICATION])
    assert collected(many, "ranking", "application") == [
        (i + 1, f"app{i:04d}") for i in range(1100)
    ]


def test_a_host_talking_to_itself_counts_twice(spark):
    given = [flow(T0, T0, 7, dst_address="10.0.0.1")]
    found = build_summaries(flows(spark, given), shapes_of_hosts := FlowOptions(), [G.HOST])
    assert shapes_of_hosts.top_k == 10
    assert collected(found, "host_address", "bytes_total") == [("10.0.0.1", 14)]


def test_incomplete_conversations_count_in_totals_only(spark):
    given = [
        flow(T0, T0, 1, protocol=None),
        flow(T0, T0, 2, src_address=""),
        flow(T0, T0, 4, location=None),
        flow(T0, T0, 8),
    ]
    found = build_summaries(flows(spark, given)).cache()
    talks = found.filter(F.col("grouped_by") == G.CONVERSATION)
    assert collected(talks, "bytes_total") == [(8,)]
    total = found.filter(F.col("grouped_by") == G.INTERFACE)
    assert collected(total, "bytes_total") == [(15,)]
    hosts = found.filter(F.col("grouped_by") == G.HOST)
    assert collected(hosts, "host_address", "bytes_total") == [
        ("", 2), ("10.0.0.1", 13), ("10.0.0.2", 15),
    ]
    found.unpersist()


def test_dropped_flows_are_accounted_for(spark):
    options = FlowOptions(max_flow_duration_ms=120_000)
    given = [
        flow(T0, T0, 1, node_id=None),
        flow(10, T0, 1),
        flow(T0, T0 - 1, 1),
        flow(T0 - 600_000, T0, 1),
        flow(T0, T0, 1),
        # A start decades back must not be spread over millions of windows.
        flow(shift_ms := 59_999, T0, 1000),
    ]
    assert shift_ms == 59_999
    found = windowing.quarantine(flows(spark, given), options)
    reasons = collected(found, "reason")
    assert [r for r, in reasons] == [
        "end_before_start", "missing_exporter", "reaches_back", "reaches_back",
        "start_before_shift",
    ]
    assert windowing.window_rows(flows(spark, given), options).count() == 2 + 2 + 1


def test_escaped_conversation_keys(spark):
    given = [flow(T0, T0, 1, application='a "b" <c>', location="it's\\n")]
    found = build_summaries(flows(spark, given), FlowOptions(), [G.CONVERSATION])
    assert collected(found, "conversation_key") == [
        (
            '["it\\u0027s\\\\n",6,"10.0.0.1","10.0.0.2","a \\"b\\" \\u003cc\\u003e"]',
        )
    ]


def test_clock_skew_and_reversed_flow(spark):
    """Exporters whose clocks are an hour apart keep their windows apart."""
    options = FlowOptions(fixed_window_size_ms=10_000)
    given, expected = [], {}
    for node, offset in ((1, 3_600_000), (2, 0), (3, -3_600_000)):
        base = window_start(node, 10_000, T0 + offset)
        for a, b, size in ((5, 11, 50), (7, 12, 100), (9, 14, 150)):
            start, end = base + a * 1000, base + b * 1000
            given.append(flow(start, end, size, node_id=node, foreign_id=f"Router{node}"))
        expected[node] = 300
    given.append(flow(T0 + 500_000, T0, 99, node_id=0))
    found = build_summaries(flows(spark, given), options, [G.INTERFACE])
    totals = found.groupBy("node_id").agg(
        F.sum("bytes_total").alias("b"), F.count("*").alias("n")
    )
    assert {row.node_id: (row.b, row.n) for row in totals.collect()} == {
        node: (size, 2) for node, size in expected.items()
    }
