"""Metric samples of ranked sums."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from netrill.config import FlowOptions
from netrill.functions import metrics
from netrill.operators import ranges
from netrill.plans import groupings as G
from netrill.schema import CONVERSATION_COLUMNS, EXPORTER_COLUMNS

# The key of a series, apart from its direction and pane.
SERIES_COLUMNS = ("grouped_by", *EXPORTER_COLUMNS, "if_index", "dscp", *CONVERSATION_COLUMNS)


def _is(test) -> Column:
    return F.col("grouped_by").isin(*[n for n, shape in G.GROUPINGS.items() if test(shape)])


def shapes(options: FlowOptions) -> list[str]:
    """The shapes that may become samples; the others need not be summed."""
    hosts = bool(options.considered_hosts.strip())
    return [
        name
        for name in G.EMITTED
        if not G.GROUPINGS[name].is_conversation and (hosts or not G.GROUPINGS[name].is_host)
    ]


def included(ranked: DataFrame, options: FlowOptions) -> DataFrame:
    """Rows that become samples: no conversations, hosts only if configured."""
    no_hosts = ~_is(lambda s: s.is_host or s.is_conversation)
    if not any(entry.strip() for entry in options.considered_hosts.split(",")):
        return ranked.filter(no_hosts)
    wanted = ranges.configured_ranges(ranked.sparkSession, options.considered_hosts)
    # One pass over the ranked rows; only hosts have an address to look up.
    hosts = _is(lambda s: s.is_host)
    looked_up = ranked.filter(no_hosts | hosts).withColumn("host", F.when(hosts, F.col("address")))
    return ranges.in_ranges(looked_up, "host", wanted, others=no_hosts).drop("host")


def metric_name() -> Column:
    """Totals are named after their shape; the others carry node and interface."""
    prefix = F.col("grouped_by")
    for name, shape in G.GROUPINGS.items():
        if shape.metric_prefix:
            prefix = F.when(F.col("grouped_by") == name, shape.metric_prefix).otherwise(prefix)
    node = F.concat(F.col("node_id"), F.lit("_"), F.col("if_index"))
    return F.when(_is(lambda s: s.is_total), prefix).otherwise(F.concat(prefix, node))


def labels() -> Column:
    """Labels besides name, pane and direction; a missing value reads ``null``."""
    total, conversation = _is(lambda s: s.is_total), _is(lambda s: s.is_conversation)
    interface = total & (F.col("grouped_by") != G.EXPORTER)
    application = conversation | _is(lambda s: s.own_columns == ("application",))
    host = conversation | _is(lambda s: s.is_host)
    wanted = [
        ("nodeId", total, "node_id"),
        ("ifIndex", interface, "if_index"),
        ("dscp", _is(lambda s: s.has_dscp), "dscp"),
        ("location", conversation, "location"),
        ("protocol", conversation, "protocol"),
        ("host", host, "address"),
        ("host2", conversation, "larger_address"),
        ("application", application, "application"),
    ]
    entries = F.array(
        *[
            F.when(
                test,
                F.struct(
                    F.lit(name).alias("key"),
                    F.coalesce(F.col(column).cast("string"), F.lit("null")).alias("value"),
                ),
            )
            for name, test, column in wanted
        ]
    )
    return F.map_from_entries(F.filter(entries, lambda entry: entry.isNotNull()))


def with_pane(rows: DataFrame, arrival: Column) -> DataFrame:
    """Number the rows of equal series and time in order of arrival.

    Taken in time order, this is the smallest index whose earlier samples are
    all older. It partitions by series *and* time, so a long series is spread.
    """
    order = Window.partitionBy(*SERIES_COLUMNS, "window_start").orderBy(arrival)
    return rows.withColumn("pane", F.row_number().over(order) - 1)


def to_samples(
    rows: DataFrame, window_ms: int, fixed_labels: Mapping[str, str] | None = None
) -> DataFrame:
    """Two samples per row, bytes in and bytes out, at the window's last ms."""
    directions = F.array(
        F.struct(F.lit("in").alias("direction"), F.col("bytes_in").alias("bytes")),
        F.struct(F.lit("out").alias("direction"), F.col("bytes_out").alias("bytes")),
    )
    fixed = [
        part
        for name, value in (fixed_labels or {}).items()
        for part in (metrics.sanitize_label_name(F.lit(name)), F.lit(value))
    ]
    common = F.create_map(
        *fixed,
        F.lit(metrics.METRIC_NAME_LABEL),
        metrics.sanitize_metric_name(metric_name()),
        F.lit("pane"),
        F.col("pane").cast("string"),
    )
    return (
        rows.withColumn("common", F.map_concat(common, labels()))
        .withColumn("side", F.explode(directions))
        .select(
            *SERIES_COLUMNS,
            "pane",
            F.col("side.direction").alias("direction"),
            F.map_concat(
                F.col("common"), F.create_map(F.lit("direction"), F.col("side.direction"))
            ).alias("labels"),
            (F.col("window_start") + F.lit(window_ms - 1)).alias("ts_ms"),
            F.col("side.bytes").cast("double").alias("value"),
        )
    )


def label_text(column: Column) -> Column:
    """Labels as one text in name order, to compare or to sort series by."""
    entries = F.transform(
        F.array_sort(F.map_entries(column)), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return F.array_join(entries, ",")
