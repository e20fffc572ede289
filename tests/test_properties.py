"""Properties over generated inputs; each run is one Spark job over many cases."""

import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import shift
from netrill.functions import windows
from netrill.streaming.series import place


def test_parts_of_a_flow_add_up(spark):
    rng = random.Random(7)
    cases = []
    for number in range(3000):
        delta, length, size = rng.randint(0, 1000), rng.randint(0, 1000), rng.randint(0, 1000)
        multiplier = 1.0 if rng.random() < 0.3 else rng.uniform(0.1, 100)
        cases.append((number, delta, delta + length, size * multiplier, rng.randint(1, 1001)))
    frame = spark.createDataFrame(
        cases, "id int, delta bigint, last bigint, scaled double, size bigint"
    )
    first, final = "delta div size", "last div size"
    rows = frame.withColumn("n", F.expr(f"explode(sequence({first}, {final}))"))
    share = windows.bytes_in_window(
        F.col("delta"), F.col("last"), F.col("scaled"),
        F.col("n") * F.col("size"), (F.col("n") + 1) * F.col("size"),
    )
    sums = rows.groupBy("id", "scaled").agg(F.sum(share).alias("b"), F.min(share).alias("least"))
    wrong = sums.filter((F.col("b") != F.col("scaled").cast("bigint")) | (F.col("least") < 0))
    assert wrong.count() == 0


def test_window_starts_agree(spark):
    for size in range(1, 11):
        nodes = spark.range(0, 11).withColumnRenamed("id", "node")
        cases = nodes.withColumn("ts", F.explode(F.sequence(F.lit(100), F.lit(1000))))
        phase = windows.node_shift(F.col("node").cast("int"), size)
        ts = F.col("ts").cast("bigint")
        start = windows.window_start(ts, phase, size)
        other = windows.start_of_window(windows.window_number(ts, phase, size), phase, size)
        found = cases.select("node", ts.alias("ts"), phase.alias("p"), start.alias("a"), other.alias("b"))
        wrong = found.filter(
            "a <> b or ts < a or ts >= a + {0} or (a - p) % {0} <> 0".format(size)
        )
        assert wrong.count() == 0
        phases = {r.node: r.p for r in found.select("node", "p").distinct().collect()}
        assert phases == {node: shift(node, size) for node in range(11)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5).map(lambda s: s * 1000), min_size=1, max_size=10))
def test_pane_indexes(times):
    slots, by_time, by_index, taken = [], {}, {}, []
    for ts in times:
        index = place(slots, ts)
        assert all(i < index for i in by_time.get(ts, []))
        assert all(t < ts for t in by_index.get(index, []))
        # No smaller index would do: each has a sample that is not older.
        assert all(max(by_index[i]) >= ts for i in range(index))
        by_time.setdefault(ts, []).append(index)
        by_index.setdefault(index, []).append(ts)
        taken.append(index)


def test_pane_index_example():
    slots = []
    assert [place(slots, ts) for ts in (10, 10, 20, 10)] == [0, 1, 0, 2]
