"""Spread flows over the windows they overlap, and account for dropped ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from netrill.config import FlowOptions
from netrill.functions import windows
from netrill.operators import normalize

MISSING_EXPORTER = "missing_exporter"
START_BEFORE_SHIFT = "start_before_shift"
END_BEFORE_START = "end_before_start"
REACHES_BACK = "reaches_back"
AHEAD_OF_CLOCK = "ahead_of_clock"


def _span(options: FlowOptions) -> tuple[Column, Column, Column]:
    """First, last and first kept window number of a flow."""
    size = options.fixed_window_size_ms
    delta, last, shift = F.col("delta_switched"), F.col("last_switched"), F.col("shift")
    first = windows.window_number(delta, shift, size)
    final = windows.window_number(last, shift, size)
    skipped = windows.windows_reaching_back(delta, last, size, options.max_flow_duration_ms)
    return first, final, first + skipped


def prepared(flows: DataFrame, options: FlowOptions) -> DataFrame:
    """Flow records with start filled in and window phase known."""
    return normalize.with_shift(normalize.with_delta(flows), options.fixed_window_size_ms)


def drop_reason(options: FlowOptions) -> Column:
    """Why a whole flow yields no rows, or null if it may."""
    last = F.coalesce(F.col("last_switched"), F.lit(0).cast("bigint"))
    ahead = F.lit(False)
    if options.max_clock_ahead_ms is not None:
        limit = F.unix_millis(F.current_timestamp()) + F.lit(options.max_clock_ahead_ms)
        ahead = last > limit
    return (
        F.when(F.col("node_id").isNull(), MISSING_EXPORTER)
        .when(F.col("delta_switched") < F.col("shift"), START_BEFORE_SHIFT)
        .when(last < F.col("delta_switched"), END_BEFORE_START)
        .when(ahead, AHEAD_OF_CLOCK)
    )


def explode_windows(flows: DataFrame, options: FlowOptions) -> DataFrame:
    """One row per window a normalised flow overlaps, both ends inclusive.

    Adds ``window_start``, ``window_end`` and ``emit_ts``, the time the row
    would be emitted at. Windows that start more than the longest allowed
    duration before the flow's end are left out, as are unusable flows.

    The conditions choose what to explode instead of filtering first: a filter
    would be pushed below the projections and evaluate their expressions again.
    """
    size = options.fixed_window_size_ms
    wide = F.lit(size).cast("bigint")
    first, final, kept_from = _span(options)
    spanned = (
        flows.withColumn("first_number", first)
        .withColumn("final_number", final)
        .withColumn("kept_from", kept_from)
    )
    usable = drop_reason(options).isNull() & (F.col("kept_from") <= F.col("final_number"))
    exploded = spanned.withColumn(
        "window_number", F.explode(F.when(usable, F.sequence("kept_from", "final_number")))
    )
    start = windows.start_of_window(F.col("window_number"), F.col("shift"), size)
    emitted = F.least(
        F.col("delta_switched") + (F.col("window_number") - F.col("first_number")) * wide,
        F.col("last_switched"),
    )
    return (
        exploded.withColumn("window_start", start)
        .withColumn("window_end", F.col("window_start") + wide)
        .withColumn("emit_ts", emitted)
        .drop("first_number", "final_number", "kept_from")
    )


def window_rows(
    flows: DataFrame, options: FlowOptions, keep: Sequence[str] = ()
) -> DataFrame:
    """Keyed rows: full key, window, bytes by direction, names and flags."""
    located = flows.filter(F.col("node_id").isNotNull())
    exploded = explode_windows(normalize.canonical(prepared(located, options), keep), options)
    share = windows.bytes_in_window(
        F.col("delta_switched"),
        F.col("last_switched"),
        F.col("scaled_bytes"),
        F.col("window_start"),
        F.col("window_end"),
    )
    none = F.lit(0).cast("bigint")
    return (
        exploded.withColumn("share", share)
        .select(
            "window_start",
            "window_end",
            *normalize.KEY_COLUMNS,
            F.when(F.col("ingress"), F.col("share")).otherwise(none).alias("bytes_in"),
            F.when(F.col("ingress"), none).otherwise(F.col("share")).alias("bytes_out"),
            *normalize.VALUE_COLUMNS,
            *keep,
        )
    )


def quarantine(flows: DataFrame, options: FlowOptions) -> DataFrame:
    """Flows that lost all or some of their windows, with the reason.

    ``dropped_windows`` is null where a flow has no windows to count.
    """
    first, final, kept_from = _span(options)
    known = prepared(flows, options).withColumn("whole_reason", drop_reason(options))
    all_windows = final - first + 1
    lost = F.when(F.col("whole_reason").isNull(), F.least(kept_from - first, all_windows))
    return (
        known.withColumn("dropped_windows", lost)
        .withColumn(
            "reason",
            F.coalesce(
                F.col("whole_reason"), F.when(F.col("dropped_windows") > 0, F.lit(REACHES_BACK))
            ),
        )
        .filter(F.col("reason").isNotNull())
        .drop("whole_reason", "shift")
    )
