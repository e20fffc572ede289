"""Queries over sums, rankings, summaries and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from netrill.catalog.oracle import CONV, ITF
from netrill.catalog.registry import register
from netrill.config import FlowOptions
from netrill.operators import aggregate, normalize, observe, reports, windowing
from netrill.plans import groupings as G
from netrill.plans import sums
from netrill.plans.summaries import build_summaries
from netrill.schema import SUMMARY_COLUMNS
from netrill.sources import tables

OPTIONS = FlowOptions()
VALUES = ", ".join(aggregate.VALUES)


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowing.window_rows(tables.flows(spark, sf_dir), OPTIONS)


def _sums(spark: SparkSession, sf_dir: str, shape: str) -> DataFrame:
    found = sums.shape_sums(_rows(spark, sf_dir), [shape])
    own = [name for name in G.GROUPINGS[shape].columns]
    host = ["hostname"] if G.GROUPINGS[shape].is_host else []
    return found.select("window_start", *own, *host, *aggregate.VALUES)


def _summaries(spark: SparkSession, sf_dir: str, *shapes: str) -> DataFrame:
    return build_summaries(tables.flows(spark, sf_dir), OPTIONS, shapes or G.EMITTED)


@register(
    "merge_aggregate",
    f"select node_id, if_index, {VALUES}, hostname, hostname2 from (select node_id, if_index,"
    " cast(sum(bytes_in) as bigint) as bytes_in, cast(sum(bytes_out) as bigint) as bytes_out,"
    " bool_or(congestion_encountered) as congestion_encountered, bool_or(non_ect) as non_ect,"
    " min(hostname) as hostname, min(hostname2) as hostname2 from win group by all)",
)
def merge_aggregate(spark, sf_dir):
    keys = ["node_id", "if_index"]
    merged = [*aggregate.merged_values(), *aggregate.merged_names("hostname", "hostname2")]
    return _rows(spark, sf_dir).groupBy(*keys).agg(*merged)


@register(
    "sum_conversation_tos",
    f"select window_start, {ITF}, dscp, {CONV}, {VALUES}, hostname, hostname2 from leaf",
)
def sum_conversation_tos(spark, sf_dir):
    return sums.leaf_sums(_rows(spark, sf_dir))


for _name, _shape in {
    "sum_conversation": G.CONVERSATION,
    "sum_app_tos": G.TOS_APPLICATION,
    "sum_app": G.APPLICATION,
    "sum_host_tos": G.TOS_HOST,
    "sum_host": G.HOST,
    "total_exporter_interface_tos": G.TOS,
    "total_exporter_interface": G.INTERFACE,
}.items():
    register(_name, f"select * from sum_{_shape.lower()}")(
        lambda spark, sf_dir, shape=_shape: _sums(spark, sf_dir, shape)
    )


@register(
    "total_exporter",
    "select window_start, node_id, foreign_source, foreign_id, cast(sum(bytes_in) as bigint) as"
    " bytes_in, cast(sum(bytes_out) as bigint) as bytes_out, bool_or(congestion_encountered) as"
    " congestion_encountered, bool_or(non_ect) as non_ect from win group by all",
)
def total_exporter(spark, sf_dir):
    return _sums(spark, sf_dir, G.EXPORTER)


def _grouping_sets_sql() -> str:
    names = [n for n in G.EMITTED if not G.GROUPINGS[n].is_host]
    columns = ["dscp", *sums.CONVERSATION_COLUMNS]
    parts = []
    for name in names:
        present = G.GROUPINGS[name].columns
        kinds = {"dscp": "integer", "protocol": "integer"}
        chosen = [
            c if c in present else f"cast(null as {kinds.get(c, 'varchar')}) as {c}"
            for c in columns
        ]
        parts.append(
            f"select '{name}' as grouped_by, window_start, {ITF}, {', '.join(chosen)}, {VALUES}"
            f" from sum_{name.lower()}"
        )
    return " union all ".join(parts)


@register("grouping_sets_all", _grouping_sets_sql())
def grouping_sets_all(spark, sf_dir):
    names = [name for name in G.EMITTED if not G.GROUPINGS[name].is_host]
    return sums.shape_sums(_rows(spark, sf_dir), names).select(
        "grouped_by", *sums.KEY_COLUMNS, *aggregate.VALUES
    )


@register(
    "sum_over_panes",
    f"select window_start, {ITF}, {VALUES} from sum_exporter_interface",
)
def sum_over_panes(spark, sf_dir):
    """Three panes per window, cut by the flows' byte counts, add up again."""
    flows = tables.flows(spark, sf_dir)
    rows = windowing.explode_windows(
        normalize.canonical(windowing.prepared(flows, OPTIONS)), OPTIONS
    ).withColumn("pane", F.pmod(F.col("last_switched"), F.lit(3)))
    share = windowing.windows.bytes_in_window(
        F.col("delta_switched"), F.col("last_switched"), F.col("scaled_bytes"),
        F.col("window_start"), F.col("window_end"),
    )
    zero = F.lit(0).cast("bigint")
    keys = ["window_start", *aggregate.BASE_COLUMNS[1:]]
    panes = (
        rows.withColumn("share", share)
        .withColumn("bytes_in", F.when(F.col("ingress"), F.col("share")).otherwise(zero))
        .withColumn("bytes_out", F.when(F.col("ingress"), zero).otherwise(F.col("share")))
        .groupBy("pane", *keys)
        .agg(*aggregate.merged_values())
    )
    return reports.sum_over_panes(panes, keys)


@register(
    "hostname_pick",
    "select address, min(hostname) as hostname, count(distinct hostname) as names from hosts"
    " group by all",
)
def hostname_pick(spark, sf_dir):
    """Smallest present name per address; distinct pairs first, then few rows."""
    pairs = aggregate.with_endpoints(_rows(spark, sf_dir)).select("address", "hostname").distinct()
    return pairs.groupBy("address").agg(
        *aggregate.merged_names("hostname"), F.count("hostname").alias("names")
    )


@register(
    "window_stats",
    f"select {ITF}, count(*) as windows, min(b) as min_bytes, max(b) as max_bytes,"
    " cast(sum(b) as double) / count(*) as avg_bytes, cast(sum(b) as bigint) as sum_bytes from"
    " (select *, bytes_in + bytes_out as b from sum_exporter_interface) group by all",
)
def window_stats(spark, sf_dir):
    return reports.window_stats(_summaries(spark, sf_dir, G.INTERFACE))


@register(
    "app_totals_per_window",
    f"select {ITF}, range_start, cast(sum(bytes_total) as bigint) as bytes_total, count(*) as"
    " applications from out_exporter_interface_application group by all",
)
def app_totals_per_window(spark, sf_dir):
    return reports.application_totals(_summaries(spark, sf_dir, G.APPLICATION))


@register(
    "trim_boundary_windows",
    f"""select node_id, if_index, range_start, bytes_total from (select *,
      min(range_end) over (partition by {ITF}) as a, max(range_end) over (partition by {ITF}) as b
      from out_exporter_interface) where range_end <> a and range_end <> b""",
)
def trim_boundary_windows(spark, sf_dir):
    trimmed = reports.trim_boundary_windows(_summaries(spark, sf_dir, G.INTERFACE))
    return trimmed.select("node_id", "if_index", "range_start", "bytes_total")


for _name, _shape in {
    "topk_app": G.APPLICATION,
    "topk_app_tos": G.TOS_APPLICATION,
    "topk_host": G.HOST,
    "topk_host_tos": G.TOS_HOST,
    "topk_conversation": G.CONVERSATION,
    "topk_conversation_tos": G.TOS_CONVERSATION,
}.items():
    register(_name, f"select * from out_{_shape.lower()}")(
        lambda spark, sf_dir, shape=_shape: _summaries(spark, sf_dir, shape)
    )


@register(
    "topk_operator",
    "select range_start, node_id, if_index, grouped_by_key, bytes_total, ranking"
    " from out_exporter_interface_application where ranking <= 3",
)
def topk_operator(spark, sf_dir):
    options = FlowOptions(top_k=3)
    found = build_summaries(tables.flows(spark, sf_dir), options, [G.APPLICATION])
    return found.select(
        "range_start", "node_id", "if_index", "grouped_by_key", "bytes_total", "ranking"
    )


@register(
    "complete_conversation",
    f"select window_start, {ITF}, {CONV}, bytes_in, bytes_out from"
    " sum_exporter_interface_conversation where location is not null and protocol is not null"
    " and address <> '' and larger_address <> ''",
)
def complete_conversation(spark, sf_dir):
    from netrill.operators.topk import complete_conversation as complete

    found = _sums(spark, sf_dir, G.CONVERSATION).filter(complete())
    return found.drop("congestion_encountered", "non_ect")


_OTHER = """
  select range_start, range_end, node_id, foreign_source, foreign_id, if_index{dscp},
    {item} as item, bytes_ingress, bytes_egress, bytes_total, false as is_other from out_{shape}
  union all
  select p.range_start, p.range_end, p.node_id, p.foreign_source, p.foreign_id, p.if_index{pdscp},
    'other', p.bytes_ingress - coalesce(c.i, 0), p.bytes_egress - coalesce(c.e, 0),
    p.bytes_total - coalesce(c.t, 0), true
  from out_{parent} p left join (select range_start, node_id, if_index{dscp},
    cast(sum(bytes_ingress) as bigint) as i, cast(sum(bytes_egress) as bigint) as e,
    cast(sum(bytes_total) as bigint) as t from out_{shape} group by all) c
  on p.range_start = c.range_start and p.node_id = c.node_id and p.if_index = c.if_index{on}
"""


def _other(shape: str) -> str:
    tos = G.GROUPINGS[shape].has_dscp
    return _OTHER.format(
        shape=shape.lower(),
        parent=G.GROUPINGS[shape].parent.lower(),
        item="conversation_key" if G.GROUPINGS[shape].is_conversation else "application",
        dscp=", dscp" if tos else "",
        pdscp=", p.dscp" if tos else "",
        on=" and p.dscp = c.dscp" if tos else "",
    )


for _name, _shape in {
    "topk_with_other": G.APPLICATION,
    "topk_with_other_tos": G.TOS_APPLICATION,
    "topk_with_other_conversation": G.CONVERSATION,
}.items():

    def _with_other(spark, sf_dir, shape=_shape):
        found = _summaries(spark, sf_dir, G.GROUPINGS[shape].parent, shape)
        return reports.with_other(found, shape)

    register(_name, _other(_shape))(_with_other)


@register(
    "recent_summaries",
    "select * from out_exporter_interface_application order by range_end, node_id,"
    " grouped_by_key limit 100",
)
def recent_summaries(spark, sf_dir):
    return reports.recent_summaries(_summaries(spark, sf_dir, G.APPLICATION), G.APPLICATION, 100)


@register("all_summaries", f"select {', '.join(SUMMARY_COLUMNS)} from summaries")
def all_summaries(spark, sf_dir):
    return _summaries(spark, sf_dir)


@register("totals_only", "select * from summaries where aggregation_type = 'TOTAL'")
def totals_only(spark, sf_dir):
    # Shapes that aren't totals are not summed in the first place.
    return reports.totals_only(_summaries(spark, sf_dir, G.INTERFACE, G.TOS))


@register(
    "flow_counters",
    """select (select count(*) from flows) as flows_read, (select count(*) from win) as in_window,
      (select count(*) from exploded) - (select count(*) from win) as reaches_back,
      (select count(*) from flows where node_id is null) as missing_exporter,
      (select count(*) from shifted where node_id is not null and ds < shift)
        as start_before_shift,
      (select count(*) from shifted where node_id is not null and ds >= shift and ls < ds)
        as end_before_start,
      (select max(last_switched) from flows) as newest_switched""",
    max_duration_ms=60_000,
)
def flow_counters(spark, sf_dir):
    options = FlowOptions(max_flow_duration_ms=60_000)
    return observe.flow_counters(tables.flows(spark, sf_dir), options)


@register(
    "reconcile_totals",
    "select count(*) as compared, 0 as mismatches from sum_exporter_interface",
)
def reconcile_totals(spark, sf_dir):
    flows = tables.flows(spark, sf_dir)
    return observe.reconciliation(flows, _summaries(spark, sf_dir, G.INTERFACE), OPTIONS)
