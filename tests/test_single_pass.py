"""Reports and sinks evaluate the summaries once."""

from helpers import flow, flows
from netrill.catalog import outputs
from netrill.operators import reports
from netrill.plans import groupings as G
from netrill.plans.summaries import build_summaries
from pyspark.sql import functions as F


def _plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_other_bucket_comes_from_one_pass(spark):
    records = [flow(1_000_000, 1_000_009, 10 * n, application=f"app{n}") for n in range(1, 15)]
    found = build_summaries(flows(spark, records)).localCheckpoint()
    got = reports.with_other(found, G.APPLICATION)
    assert _plan(got).count("LogicalRDD") == 1
    rows = got.select("item", "bytes_ingress", "bytes_egress", "bytes_total", "is_other").collect()
    ranked = [(f"app{n}", 10 * n, 0, 10 * n, False) for n in range(5, 15)]
    assert sorted(map(tuple, rows)) == sorted([*ranked, ("other", 100, 0, 100, True)])
    # Also of a parent that has no row itself, or none but itself.
    listed = reports.with_other(found.where(F.col("grouped_by") == G.APPLICATION), G.APPLICATION)
    assert sorted(r.bytes_total for r in listed.collect() if r.is_other) == [-950]
    total = reports.with_other(found.where(F.col("grouped_by") == G.INTERFACE), G.APPLICATION)
    assert [(r.item, r.bytes_total) for r in total.collect()] == [("other", 1050)]


def test_documents_written_twice_are_made_once(spark, tmp_path, monkeypatch):
    line = spark.range(40).selectExpr(
        "id as l_orderkey", "id as l_partkey", "id as l_suppkey", "cast(id % 7 as int) as l_linenumber",
        "cast(5 as double) as l_quantity", "'N' as l_returnflag",
    )
    line.write.parquet(f"{tmp_path}/lineitem.parquet")
    plans, write = [], outputs.writers.write_documents

    def seen(summaries, *more):
        plans.append(_plan(summaries))
        write(summaries, *more)

    monkeypatch.setattr(outputs.writers, "write_documents", seen)
    assert outputs.sink_search_docs(spark, str(tmp_path)).count() > 0
    assert len(plans) == 2 and not any("Aggregate" in plan for plan in plans)
