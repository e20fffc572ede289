"""Flow summaries: totals and top-K tables of every window."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from netrill.config import FlowOptions
from netrill.functions import keys
from netrill.operators import topk
from netrill.operators.windowing import window_rows
from netrill.plans import groupings as G
from netrill.plans.sums import RANKED, shape_sums
from netrill.schema import CONVERSATION_COLUMNS, EXPORTER_COLUMNS, SUMMARY_COLUMNS

TOTAL_NAMES = tuple(name for name, shape in G.GROUPINGS.items() if shape.is_total)
HOST_NAMES = tuple(name for name, shape in G.GROUPINGS.items() if shape.is_host)
CONVERSATION_NAMES = tuple(name for name, shape in G.GROUPINGS.items() if shape.is_conversation)

# One row per window, shape and parent key shares these. For a total they
# identify the row itself, so totals always rank first and are all kept. The
# most telling columns come first: they decide most comparisons of the sort.
PARENT_COLUMNS = ("window_start", "if_index", "dscp", *EXPORTER_COLUMNS, "grouped_by")


def _shape_is(names: Sequence[str]) -> Column:
    return F.col("grouped_by").isin(*names)


def own_key() -> Column:
    """Text of the part of a key below its parent; orders ties."""
    conversation = keys.conversation_key(*[F.col(name) for name in CONVERSATION_COLUMNS])
    return (
        F.when(_shape_is(CONVERSATION_NAMES), conversation)
        .when(_shape_is(HOST_NAMES), F.col("address"))
        .when(~_shape_is(TOTAL_NAMES), F.col("application"))
    )


def grouped_by_key() -> Column:
    """The whole key as text; parts a shape does not have are skipped."""
    exporter = keys.exporter_key(*[F.col(name) for name in EXPORTER_COLUMNS])
    return F.concat_ws("-", exporter, F.col("if_index"), F.col("dscp"), F.col("own_key"))


def rank_shapes(sums: DataFrame, k: int) -> DataFrame:
    """Keep totals, and the top ``k`` of every other shape inside its parent."""
    eligible = sums.filter(RANKED).withColumn("own_key", own_key())
    amount = F.col("bytes_in") + F.col("bytes_out")
    return topk.keep_top(eligible, PARENT_COLUMNS, amount, F.col("own_key"), k)


def to_summaries(ranked: DataFrame, window_ms: int, keep: Sequence[str] = ()) -> DataFrame:
    """Ranked sums in output form, see ``SUMMARY_COLUMNS``, and the columns in ``keep``."""
    is_total, is_host = _shape_is(TOTAL_NAMES), _shape_is(HOST_NAMES)
    is_conversation = _shape_is(CONVERSATION_NAMES)
    columns = {
        "range_start": F.col("window_start"),
        "range_end": F.col("window_start") + F.lit(window_ms).cast("bigint"),
        "grouped_by": F.col("grouped_by"),
        "aggregation_type": F.when(is_total, F.lit("TOTAL")).otherwise(F.lit("TOPK")),
        "bytes_ingress": F.col("bytes_in"),
        "bytes_egress": F.col("bytes_out"),
        "bytes_total": F.col("bytes_in") + F.col("bytes_out"),
        "dscp": F.col("dscp"),
        "congestion_encountered": F.col("congestion_encountered"),
        "non_ect": F.col("non_ect"),
        "node_id": F.col("node_id"),
        "foreign_source": F.col("foreign_source"),
        "foreign_id": F.col("foreign_id"),
        "if_index": F.col("if_index"),
        "application": F.when(~is_conversation, F.col("application")),
        "host_address": F.when(is_host, F.col("address")),
        "host_name": F.when(is_host, F.col("hostname")),
        "conversation_key": F.when(is_conversation, F.col("own_key")),
        "grouped_by_key": grouped_by_key(),
        "ranking": F.when(~is_total, F.col("ranking")),
    }
    return ranked.select(*[columns[name].alias(name) for name in SUMMARY_COLUMNS], *keep)


def summaries_of_rows(
    rows: DataFrame,
    options: FlowOptions,
    groupings: Sequence[str] = G.EMITTED,
    include: Column | None = None,
) -> DataFrame:
    """Summaries of keyed rows; ``include`` chooses the ranked conversations."""
    rankable = topk.complete_conversation() if include is None else include
    ranked = rank_shapes(shape_sums(rows, groupings, rankable), options.top_k)
    return to_summaries(ranked, options.fixed_window_size_ms)


def build_summaries(
    flows: DataFrame,
    options: FlowOptions = FlowOptions(),
    groupings: Sequence[str] = G.EMITTED,
    windowing: Callable[[DataFrame, FlowOptions], DataFrame] = window_rows,
    include: Column | None = None,
) -> DataFrame:
    """All summaries of bounded flow records.

    ``windowing`` turns flows into keyed window rows and ``include`` chooses
    the conversations that are ranked; both may be replaced.
    """
    return summaries_of_rows(windowing(flows, options), options, groupings, include)
