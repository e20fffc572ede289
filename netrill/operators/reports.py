"""Queries over stored summaries and over the panes of a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from netrill.operators.aggregate import merged_names, merged_values
from netrill.plans import groupings as G

WINDOW_COLUMNS = ("range_start", "range_end")
EXPORTER_INTERFACE = ("node_id", "foreign_source", "foreign_id", "if_index")


def totals_only(summaries: DataFrame) -> DataFrame:
    return summaries.filter(F.col("aggregation_type") == "TOTAL")


def sum_over_panes(panes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add up the panes of each key and window."""
    names = [name for name in ("hostname", "hostname2") if name in panes.columns]
    return panes.groupBy(*keys).agg(*merged_values(), *merged_names(*names))


def window_stats(summaries: DataFrame) -> DataFrame:
    """Spread of the window totals of each exporter interface."""
    totals = summaries.filter(F.col("grouped_by") == G.INTERFACE)
    amount = F.col("bytes_total")
    return totals.groupBy(*EXPORTER_INTERFACE).agg(
        F.count("*").alias("windows"),
        F.min(amount).alias("min_bytes"),
        F.max(amount).alias("max_bytes"),
        F.avg(amount).alias("avg_bytes"),
        F.sum(amount).alias("sum_bytes"),
    )


def application_totals(summaries: DataFrame) -> DataFrame:
    """Sum of the application rows of each exporter interface and window."""
    rows = summaries.filter(F.col("grouped_by") == G.APPLICATION)
    return rows.groupBy(*EXPORTER_INTERFACE, "range_start").agg(
        F.sum("bytes_total").alias("bytes_total"), F.count("*").alias("applications")
    )


def trim_boundary_windows(summaries: DataFrame) -> DataFrame:
    """Without each interface's first and last window, which may be incomplete.

    The bounds are aggregated first, so no interface's rows meet in one task
    unless they are joined there, where a hot interface can be split.
    """
    bounds = summaries.groupBy(*EXPORTER_INTERFACE).agg(
        F.min("range_end").alias("first_end"), F.max("range_end").alias("last_end")
    )
    kept = summaries.alias("s")
    same = [kept[name].eqNullSafe(F.col(f"b.{name}")) for name in EXPORTER_INTERFACE]
    inner = (F.col("s.range_end") != F.col("b.first_end")) & (
        F.col("s.range_end") != F.col("b.last_end")
    )
    matched = same[0]
    for condition in same[1:]:
        matched = matched & condition
    return kept.join(bounds.alias("b"), matched & inner, "inner").select("s.*")


def with_other(summaries: DataFrame, shape: str) -> DataFrame:
    """A shape's ranked rows plus, per parent, what they leave of its total.

    Not for hosts: their bytes count at both ends of a conversation.
    """
    if G.GROUPINGS[shape].is_host:
        raise ValueError("hosts have no other bucket")
    parent = G.GROUPINGS[shape].parent
    keys = [*WINDOW_COLUMNS, *EXPORTER_INTERFACE] + (["dscp"] if parent == G.TOS else [])
    item = "conversation_key" if G.GROUPINGS[shape].is_conversation else "application"
    rows = summaries.filter(F.col("grouped_by").isin(parent, shape))
    is_total = F.col("grouped_by") == parent

    def signed(name: str) -> Column:
        return F.sum(F.when(is_total, F.col(name)).otherwise(-F.col(name)))

    measures = ["bytes_ingress", "bytes_egress", "bytes_total"]
    # One pass: every row knows what is left of its parent, and the parent's first row adds that.
    parents = Window.partitionBy(*keys)
    left = F.struct(*[signed(name).over(parents).alias(name) for name in measures])
    number = F.row_number().over(parents.orderBy("grouped_by", item))
    known = rows.select(*keys, F.col(item).alias("item"), *measures, is_total.alias("total"), left.alias("left"), number.alias("number"))
    fields = ["item", *measures]
    listed = F.struct(*fields, F.lit(False).alias("is_other"))
    other = F.struct(F.lit("other").alias("item"), *[F.col("left")[name].alias(name) for name in measures], F.lit(True).alias("is_other"))
    both = F.array(F.when(~F.col("total"), listed), F.when(F.col("number") == 1, other))
    found = known.select(*keys, F.explode(both).alias("row")).where("row is not null")
    return found.select(*keys, *[F.col("row")[name].alias(name) for name in [*fields, "is_other"]])


def recent_summaries(summaries: DataFrame, shape: str, limit: int) -> DataFrame:
    """The first ``limit`` summaries of a shape by time."""
    return (
        summaries.filter(F.col("grouped_by") == shape)
        .orderBy("range_end", "node_id", "grouped_by_key", "conversation_key")
        .limit(limit)
    )


def series_violations(samples: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Samples that are not later than the one before them in their series."""
    order = Window.partitionBy(*keys).orderBy("written")
    before = samples.withColumn("before", F.lag("ts_ms").over(order))
    return before.filter(F.col("ts_ms") <= F.col("before")).drop("before")
