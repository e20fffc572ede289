"""Counters of a run, and the check of its totals against the raw flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from netrill.config import FlowOptions
from netrill.operators import windowing
from netrill.plans import groupings as G
from netrill.schema import EXPORTER_COLUMNS


#: Name of the metrics that a running stream reports with each batch.
FLOW_COUNTERS = "flow_counters"


def counter_columns(options: FlowOptions, live: Column | None = None) -> list[Column]:
    """Counters as aggregates over prepared flows; only rows that are ``live`` count."""
    live = F.lit(True) if live is None else live
    first, final, kept_from = windowing._span(options)
    reason = windowing.drop_reason(options)
    zero = F.lit(0).cast("bigint")
    rows = F.greatest(zero, final - kept_from + 1)
    all_rows = F.greatest(zero, final - first + 1)
    used = live & reason.isNull()

    def count_of(name: str) -> Column:
        return F.count_if(live & F.coalesce(reason == name, F.lit(False))).alias(name)

    return [
        F.count_if(live).alias("flows_read"),
        F.coalesce(F.sum(F.when(used, rows)), zero).alias("in_window"),
        F.coalesce(F.sum(F.when(used, all_rows - rows)), zero).alias(windowing.REACHES_BACK),
        count_of(windowing.MISSING_EXPORTER),
        count_of(windowing.START_BEFORE_SHIFT),
        count_of(windowing.END_BEFORE_START),
        F.max(F.when(live, F.col("last_switched"))).alias("newest_switched"),
    ]


def flow_counters(flows: DataFrame, options: FlowOptions) -> DataFrame:
    """Flows read, window rows made, and why others were dropped, in one pass.

    ``newest_switched`` minus the current time is the input's drift.
    """
    return windowing.prepared(flows, options).agg(*counter_columns(options))


def observed(flows: DataFrame, options: FlowOptions, live: Column | None = None) -> DataFrame:
    """The flows, which report their counters as they pass by."""
    known = windowing.prepared(flows, options)
    return known.observe(FLOW_COUNTERS, *counter_columns(options, live)).drop("shift")


def sink_counters(batched_samples: DataFrame) -> DataFrame:
    """Samples written and batches they went in."""
    per_batch = batched_samples.groupBy("writer", "batch").agg(F.count("*").alias("samples"))
    return per_batch.agg(
        F.coalesce(F.sum("samples"), F.lit(0).cast("bigint")).alias("sample"),
        F.count("*").alias("write"),
    )


def with_clock(rows: DataFrame) -> DataFrame:
    """Add the wall-clock time at which each row passed by."""
    clock = F.reflect(F.lit("java.lang.System"), F.lit("currentTimeMillis")).cast("bigint")
    return rows.select("bytes_in", "bytes_out", clock.alias("clock_ms"))


def throughput(rows: DataFrame, clock_ms: str) -> DataFrame:
    """Rows, first and last processing time, rows per second."""
    span = F.col("last_ms") - F.col("first_ms")
    rate = F.when(span == 0, F.lit(0.0)).otherwise(F.col("rows") / span * 1000)
    return rows.agg(
        F.count("*").alias("rows"),
        F.min(clock_ms).alias("first_ms"),
        F.max(clock_ms).alias("last_ms"),
    ).withColumn("rate", rate)


def direct_totals(flows: DataFrame, options: FlowOptions) -> DataFrame:
    """Interface totals straight from the flows, without the summary plan.

    Bytes are computed per flow and window here and added up at once.
    """
    rows = windowing.window_rows(flows, options)
    return rows.groupBy("window_start", *EXPORTER_COLUMNS, "if_index").agg(
        F.sum("bytes_in").alias("direct_in"), F.sum("bytes_out").alias("direct_out")
    )


def _compared(flows: DataFrame, summaries: DataFrame, options: FlowOptions) -> DataFrame:
    """Both totals side by side, null where only one side has the key."""
    direct = direct_totals(flows, options).alias("d")
    stored = summaries.filter(F.col("grouped_by") == G.INTERFACE).alias("s")
    keys = {"window_start": "range_start", **{n: n for n in (*EXPORTER_COLUMNS, "if_index")}}
    matched = F.lit(True)
    for left, right in keys.items():
        matched = matched & F.col(f"d.{left}").eqNullSafe(F.col(f"s.{right}"))
    same = F.col("direct_in").eqNullSafe(F.col("bytes_ingress")) & F.col(
        "direct_out"
    ).eqNullSafe(F.col("bytes_egress"))
    return direct.join(stored, matched, "full_outer").select(
        *[F.coalesce(f"d.{a}", f"s.{b}").alias(a) for a, b in keys.items()],
        "direct_in",
        "direct_out",
        "bytes_ingress",
        "bytes_egress",
        same.alias("same"),
    )


def reconcile(flows: DataFrame, summaries: DataFrame, options: FlowOptions) -> DataFrame:
    """Windows and interfaces whose stored total differs from the flows'."""
    return _compared(flows, summaries, options).filter(~F.col("same")).drop("same")


def reconciliation(flows: DataFrame, summaries: DataFrame, options: FlowOptions) -> DataFrame:
    """Windows compared and mismatches found, as one row."""
    return _compared(flows, summaries, options).agg(
        F.count("*").alias("compared"), F.count_if(~F.col("same")).alias("mismatches")
    )
