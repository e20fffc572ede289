"""Stream contracts against hand-made arrivals and against the batch result."""

from pyspark.sql import functions as F

from helpers import flow, flows, window_start
from netrill import FlowOptions, build_summaries
from netrill.operators import samples
from netrill.plans import groupings as G
from netrill.plans.summaries import summaries_of_rows
from netrill.schema import SUMMARY_COLUMNS
from netrill.streaming import panes, replay, series, windows

T0 = 1_500_000_000_000
MINUTE = 60_000
S = window_start(99, MINUTE, T0)


def half_minute(start, size):
    return flow(start, start + 30_000 - 1, size)


# In order of arrival; the last two are late, one by a day.
ARRIVALS = [
    [half_minute(S, 100)],
    [half_minute(S + 30_000, 103)],
    [half_minute(S + MINUTE, 106)],
    [half_minute(S + 20 * MINUTE, 109)],
    [half_minute(S, 112)],
    [half_minute(S - 24 * 60 * MINUTE, 115)],
]
OPTIONS = FlowOptions(allowed_lateness_ms=120 * MINUTE)


def arrive(spark, folder, begin):
    """One file and one query run per arrival."""
    last = 0
    for records in ARRIVALS:
        found = flows(spark, records)
        last = max(last, replay.replay(found, ["true"], folder, begin))
    return last


def test_late_data_makes_a_second_pane(spark, tmp_path):
    folder = str(tmp_path)

    def begin(stream):
        return panes.start_panes(stream, OPTIONS, f"{folder}/checkpoint", folder)

    last = arrive(spark, folder, begin)
    panes.drain(spark, folder, last, OPTIONS)
    found = panes.read_panes(spark, folder)
    first = found.filter(F.col("window_start") == S).groupBy("batch", "timing").agg(
        F.sum("bytes_in").alias("b")
    )
    assert [(r.timing, r.b) for r in first.orderBy("batch").collect()] == [
        ("on_time", 203), ("late", 112),
    ]
    assert found.filter(F.col("window_start") < S).count() == 0
    ranked = panes.pane_summaries(found, OPTIONS, "late", [G.INTERFACE])
    assert [r.bytes_total for r in ranked.collect()] == [112]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    folder = str(tmp_path)
    first, second = flows(spark, ARRIVALS[0] + ARRIVALS[3]), flows(spark, ARRIVALS[4])
    panes.pane_batch(first, 0, folder, OPTIONS)
    panes.pane_batch(second, 1, folder, OPTIONS)
    before = sorted(map(tuple, panes.read_panes(spark, folder).collect()), key=str)
    panes.pane_batch(second, 1, folder, OPTIONS)
    assert sorted(map(tuple, panes.read_panes(spark, folder).collect()), key=str) == before


def test_final_and_upsert_give_the_batch_result(spark, tmp_path):
    every = [record for records in ARRIVALS[:5] for record in records]
    wanted = sorted(
        map(tuple, build_summaries(flows(spark, every), OPTIONS).collect()), key=str
    )
    final, upsert = str(tmp_path / "final"), str(tmp_path / "upsert")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{final}/out/batch={batch_id}")

    def begin_final(stream):
        joined = windows.with_closing(stream, final)
        return windows.start_final(joined, OPTIONS, f"{final}/checkpoint", write)

    def begin_upsert(stream):
        return windows.start_upsert(stream, OPTIONS, f"{upsert}/checkpoint", upsert)

    arrive(spark, final, begin_final)
    arrive(spark, upsert, begin_upsert)
    given = flows(spark, ARRIVALS[0])
    windows.write_closing(given, final, S + 21 * MINUTE, OPTIONS)
    begin_final(replay.arrivals(spark, final, given.schema)).awaitTermination()
    leaf = spark.read.parquet(f"{final}/out").drop("batch")
    closed = summaries_of_rows(leaf, OPTIONS).select(*SUMMARY_COLUMNS)
    assert sorted(map(tuple, closed.collect()), key=str) == wanted
    current = windows.current_summaries(spark, upsert).select(*SUMMARY_COLUMNS)
    # The flow of the day before was too late for the state, too.
    assert sorted(map(tuple, current.collect()), key=str) == wanted


def test_flows_ahead_of_the_clock_are_set_aside(spark):
    from netrill.operators import windowing

    options = FlowOptions(max_clock_ahead_ms=3_600_000)
    ahead = 4_000_000_000_000
    given = flows(spark, [flow(T0, T0, 1), flow(ahead, ahead, 2)])
    assert windowing.window_rows(given, options).count() == 1
    reasons = windowing.quarantine(given, options).select("reason").collect()
    assert [r.reason for r in reasons] == ["ahead_of_clock"]


def test_closing_records_show_up_nowhere(spark, tmp_path):
    """Neither in the state nor in current summaries, although they move the watermark."""
    folder = str(tmp_path)
    given = flows(spark, [flow(S, S + 30_000, 5, node_id=-1)])

    def begin(stream):
        joined = windows.with_closing(stream, folder)
        return windows.start_upsert(joined, OPTIONS, f"{folder}/checkpoint", folder)

    replay.replay(given, ["true"], folder, begin)
    windows.write_closing(given, folder, S, OPTIONS)
    begin(replay.arrivals(spark, folder, given.schema)).awaitTermination()
    # A real node of that number stays.
    found = windows.current_summaries(spark, folder)
    first = window_start(-1, MINUTE, S)
    assert {(r.node_id, r.range_start) for r in found.collect()} == {(-1, first), (-1, first + MINUTE)}


def test_flows_ahead_of_the_clock_are_kept(spark):
    import time

    from netrill.operators import windowing

    far = int(time.time() * 1000) + 10**12
    assert windowing.window_rows(flows(spark, [flow(far, far, 1)]), FlowOptions()).count() == 1


def test_series_indexes_on_a_stream(spark, tmp_path):
    folder = str(tmp_path)
    rows = spark.createDataFrame(
        [(T0, 1), (T0, 2), (T0 + MINUTE, 3)], "window_start bigint, bytes_in bigint"
    ).select(
        "window_start", "bytes_in", F.lit(0).cast("bigint").alias("bytes_out"),
        F.lit(False).alias("congestion_encountered"), F.lit(True).alias("non_ect"),
        F.lit(G.INTERFACE).alias("grouped_by"), F.lit(1).alias("node_id"),
        F.lit("a").alias("foreign_source"), F.lit("b").alias("foreign_id"),
        F.lit(2).alias("if_index"),
    )
    found = series.series_rows(rows)
    out = f"{folder}/out"

    def begin(stream):
        marked = windows.watermarked(
            stream.withColumn("window_end", F.col("window_start") + MINUTE), OPTIONS
        )
        numbered = series.index_panes(marked.drop("window_end"), OPTIONS)

        def write(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

        return windows.start(numbered, "append", write, f"{folder}/checkpoint")

    replay.replay(found, ["true"], folder, begin)
    late = found.filter("bytes_in = 1").withColumn("bytes_in", F.lit(4).cast("bigint"))
    replay.replay(late, ["true"], folder, begin)
    got = spark.read.parquet(out).select("window_start", "bytes_in", "pane").collect()
    assert sorted(map(tuple, got)) == [
        (T0, 1, 0), (T0, 2, 1), (T0, 4, 2), (T0 + MINUTE, 3, 0),
    ]
    labelled = samples.to_samples(spark.read.parquet(out), MINUTE)
    assert labelled.count() == 8


def test_only_slots_of_several_batches_are_merged_again(spark, tmp_path, monkeypatch):
    """A batch's rows are one per window and key already; only further batches add to them."""
    folder, seen, merge = str(tmp_path), [], panes._merged
    for number, records in enumerate([ARRIVALS[0], ARRIVALS[1], ARRIVALS[3]]):
        panes.pane_batch(flows(spark, records), number, folder, OPTIONS)

    def counted(rows):
        seen.append(rows.count())
        return merge(rows)

    monkeypatch.setattr(panes, "_merged", counted)
    panes.drain(spark, folder, 3, OPTIONS)
    assert not any(seen)
    found = panes.read_panes(spark, folder).select("window_start", "bytes_in", "timing")
    assert sorted(map(tuple, found.collect())) == [
        (S, 203, "on_time"), (S + 20 * MINUTE, 109, "on_time"),
    ]


def test_leaf_rows_are_sorted_by_the_digest_of_their_key_first(spark):
    leaf = windows.leaf_state(windows.stream_rows(flows(spark, ARRIVALS[0]), OPTIONS))
    plan = leaf._jdf.queryExecution().executedPlan().toString()
    assert "Sort [digest#" in plan and "digest" not in leaf.columns
    assert [(r.bytes_in, r.hostname) for r in leaf.collect()] == [(100, None)]


def test_the_state_holds_windows_and_no_leaf_rows(spark, tmp_path):
    folder, runs = str(tmp_path), []
    options = FlowOptions(allowed_lateness_ms=0)
    first = [flow(S, S + 9, 1 + n, src_address=f"10.1.0.{n}") for n in range(40)]
    second = [flow(S + 10, S + 19, 500, src_address="10.1.0.7"), half_minute(S + 20 * MINUTE, 109)]

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    def begin(stream):
        runs.append(windows.start_final(stream, options, f"{folder}/checkpoint", write))
        return runs[-1]

    for records in (first, second):
        replay.replay(flows(spark, records), ["true"], folder, begin)
    held = [p["stateOperators"][0]["numRowsTotal"] for query in runs for p in query.recentProgress]
    assert 0 < max(held) <= 2
    found = spark.read.parquet(f"{folder}/out").groupBy("address", "larger_address").agg(F.sum("bytes_in").alias("b"))
    assert sorted(r.b for r in found.collect()) == sorted([1 + n for n in range(40) if n != 7] + [508])


def test_windows_that_close_again_give_the_same_rows(spark, tmp_path):
    folder, given = str(tmp_path), [windows.rows_and_windows(flows(spark, ARRIVALS[n]), OPTIONS) for n in (0, 4, 3)]
    sums = []
    for number, batch in enumerate(given):
        for _ in range(2):
            closed = windows.closed_rows(batch, number, folder)
            sums.append({r.window_end: r.bytes_in for r in closed.collect() if r.bytes_in})
    # The second batch has a row of the first one's window and key.
    assert sums == [{S + MINUTE: 100}] * 2 + [{S + MINUTE: 212}] * 2 + [{S + 21 * MINUTE: 109}] * 2
