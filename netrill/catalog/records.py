"""Queries over single flow records: sources, expressions, filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from netrill.catalog.registry import register
from netrill.config import FlowOptions
from netrill.functions import keys, records, windows
from netrill.operators import normalize, ranges, windowing
from netrill.plans.sums import KEY_COLUMNS, shape_sums
from netrill.plans import groupings as G
from netrill.schema import FLOW_SCHEMA
from netrill.sources import protobuf, tables

OPTIONS = FlowOptions()
W = OPTIONS.fixed_window_size_ms
SHORT = FlowOptions(max_flow_duration_ms=60_000)
FLOW_COLUMNS = ", ".join(FLOW_SCHEMA.names)


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowing.prepared(tables.flows(spark, sf_dir), OPTIONS)


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.canonical(_prepared(spark, sf_dir))


def _exploded(spark: SparkSession, sf_dir: str, options: FlowOptions = OPTIONS) -> DataFrame:
    flows = tables.flows(spark, sf_dir).filter(F.col("node_id").isNotNull())
    return windowing.explode_windows(
        normalize.canonical(windowing.prepared(flows, options)), options
    )


@register("batch_flows", f"select {FLOW_COLUMNS} from flows")
def batch_flows(spark, sf_dir):
    return tables.flows(spark, sf_dir)


# A message has no missing texts, and no exporter texts without an exporter.
WIRE_COLUMNS = ", ".join(
    f"case when node_id is not null then {name} end as {name}"
    if name in ("foreign_source", "foreign_id")
    else f"coalesce({name}, '') as {name}"
    if name.endswith("hostname")
    else name
    for name in FLOW_SCHEMA.names
)


@register("decode_flows", f"select {WIRE_COLUMNS} from flows")
def decode_flows(spark, sf_dir):
    messages = protobuf.encode_flows(tables.flows(spark, sf_dir))
    return protobuf.accepted(protobuf.decode_flows(messages))


@register("normalize_delta_switched", "select first_switched, ds as delta_switched, last_switched from mixed")
def normalize_delta_switched(spark, sf_dir):
    return normalize.with_delta(tables.flows(spark, sf_dir)).select(
        "first_switched", "delta_switched", "last_switched"
    )


@register("per_node_shift", "select node_id, shift, count(*) as flows from shifted group by all")
def per_node_shift(spark, sf_dir):
    return _prepared(spark, sf_dir).groupBy("node_id", "shift").agg(F.count("*").alias("flows"))


@register(
    "window_number",
    f"select node_id, ds, (ds - shift) // {W} as first_number, (ls - shift) // {W} as final_number"
    " from shifted",
)
def window_number(spark, sf_dir):
    delta, last, shift = F.col("delta_switched"), F.col("last_switched"), F.col("shift")
    return _prepared(spark, sf_dir).select(
        "node_id",
        delta.alias("ds"),
        windows.window_number(delta, shift, W).alias("first_number"),
        windows.window_number(last, shift, W).alias("final_number"),
    )


@register(
    "window_start",
    f"select node_id, ls, ls - (ls - shift) % {W} as window_start,"
    f" shift + ((ls - shift) // {W}) * {W} as numbered_start from shifted",
)
def window_start(spark, sf_dir):
    last, shift = F.col("last_switched"), F.col("shift")
    number = windows.window_number(last, shift, W)
    return _prepared(spark, sf_dir).select(
        "node_id",
        last.alias("ls"),
        windows.window_start(last, shift, W).alias("window_start"),
        windows.start_of_window(number, shift, W).alias("numbered_start"),
    )


@register(
    "explode_windows",
    "select node_id, ds as delta_switched, ls as last_switched, wn as window_number,"
    " window_start, window_end, emit_ts from emitted",
)
def explode_windows(spark, sf_dir):
    return _exploded(spark, sf_dir).select(
        "node_id", "delta_switched", "last_switched", "window_number", "window_start",
        "window_end", "emit_ts",
    )


@register("bytes_in_window", "select node_id, ds, ls, window_start, share from shared")
def bytes_in_window(spark, sf_dir):
    share = windows.bytes_in_window(
        F.col("delta_switched"), F.col("last_switched"), F.col("scaled_bytes"),
        F.col("window_start"), F.col("window_end"),
    )
    return _exploded(spark, sf_dir).select(
        "node_id", F.col("delta_switched").alias("ds"), F.col("last_switched").alias("ls"),
        "window_start", share.alias("share"),
    )


@register(
    "sampling_multiplier",
    "select sampling_interval, case when sampling_interval > 0 then sampling_interval"
    " else cast(1 as double) end as multiplier, count(*) as flows from flows group by all",
)
def sampling_multiplier(spark, sf_dir):
    multiplier = records.sampling_multiplier(F.col("sampling_interval")).alias("multiplier")
    return tables.flows(spark, sf_dir).groupBy("sampling_interval", multiplier).agg(
        F.count("*").alias("flows")
    )


@register("split_direction", "select window_start, node_id, bytes_in, bytes_out from win")
def split_direction(spark, sf_dir):
    rows = windowing.window_rows(tables.flows(spark, sf_dir), OPTIONS)
    return rows.select("window_start", "node_id", "bytes_in", "bytes_out")


@register(
    "ecn_flags",
    "select ecn, coalesce(ecn = 3, false) as congestion_encountered,"
    " (ecn is null or ecn = 0) as non_ect, count(*) as flows from flows group by all",
)
def ecn_flags(spark, sf_dir):
    ecn = F.col("ecn")
    return tables.flows(spark, sf_dir).groupBy(
        ecn,
        records.congestion_encountered(ecn).alias("congestion_encountered"),
        records.non_ecn_capable(ecn).alias("non_ect"),
    ).agg(F.count("*").alias("flows"))


@register(
    "interface_by_direction",
    "select direction, input_snmp_ifindex, output_snmp_ifindex, coalesce(case when direction ="
    " 'INGRESS' then input_snmp_ifindex else output_snmp_ifindex end, 0) as if_index,"
    " count(*) as flows from flows group by all",
)
def interface_by_direction(spark, sf_dir):
    columns = ["direction", "input_snmp_ifindex", "output_snmp_ifindex"]
    chosen = records.interface_index(*[F.col(name) for name in columns])
    return tables.flows(spark, sf_dir).groupBy(*columns, chosen.alias("if_index")).agg(
        F.count("*").alias("flows")
    )


@register(
    "exporter_identity",
    "select node_id, foreign_source, foreign_id, count(*) as flows from numbered group by all",
)
def exporter_identity(spark, sf_dir):
    rows = _canonical(spark, sf_dir).filter(F.col("node_id").isNotNull())
    return rows.groupBy("node_id", "foreign_source", "foreign_id").agg(F.count("*").alias("flows"))


@register(
    "dscp_default",
    "select dscp, coalesce(dscp, 0) as code, count(*) as flows from flows group by all",
)
def dscp_default(spark, sf_dir):
    code = records.dscp_or_default(F.col("dscp")).alias("code")
    return tables.flows(spark, sf_dir).groupBy("dscp", code).agg(F.count("*").alias("flows"))


@register(
    "application_default",
    "select case when application = '' then '__unknown' else application end as application,"
    " count(*) as flows from flows group by all",
)
def application_default(spark, sf_dir):
    name = records.application_or_unknown(F.col("application")).alias("application")
    return tables.flows(spark, sf_dir).groupBy(name).agg(F.count("*").alias("flows"))


@register(
    "canonical_endpoints",
    "select address, larger_address, hostname, hostname2, count(*) as flows from numbered"
    " group by all",
)
def canonical_endpoints(spark, sf_dir):
    rows = _canonical(spark, sf_dir).filter(F.col("node_id").isNotNull())
    return rows.groupBy("address", "larger_address", "hostname", "hostname2").agg(
        F.count("*").alias("flows")
    )


@register(
    "key_conversation_tos",
    "select window_start, node_id, foreign_source, foreign_id, if_index, dscp, location, protocol,"
    " address, larger_address, application from win",
)
def key_conversation_tos(spark, sf_dir):
    rows = windowing.window_rows(tables.flows(spark, sf_dir), OPTIONS)
    return rows.select(*KEY_COLUMNS)


@register(
    "drop_start_before_shift",
    "select node_id, ds as delta_switched, shift from shifted where node_id is not null"
    " and ds >= shift",
)
def drop_start_before_shift(spark, sf_dir):
    kept = _prepared(spark, sf_dir).filter(windowing.drop_reason(OPTIONS).isNull())
    return kept.select("node_id", "delta_switched", "shift")


@register(
    "drop_reach_back",
    "select node_id, ds as delta_switched, ls as last_switched, window_start, emit_ts from emitted",
    max_duration_ms=60_000,
)
def drop_reach_back(spark, sf_dir):
    return _exploded(spark, sf_dir, SHORT).select(
        "node_id", "delta_switched", "last_switched", "window_start", "emit_ts"
    )


@register(
    "drop_missing_exporter",
    "select node_id, count(*) as flows from flows where node_id is not null group by all",
)
def drop_missing_exporter(spark, sf_dir):
    kept = _prepared(spark, sf_dir).filter(windowing.drop_reason(OPTIONS).isNull())
    return kept.groupBy("node_id").agg(F.count("*").alias("flows"))


@register(
    "quarantine",
    """, lost as (select s.*, (ds - shift) // 60000 as first_n, (ls - shift) // 60000 as last_n
      from shifted s)
    , counted as (select *, case when node_id is not null and ds >= shift and ls >= ds then
      len(list_filter(range(first_n, last_n + 1),
        lambda n: least(ds + (n - first_n) * 60000, ls) <= ls - 60000)) end as dropped from lost)
    select case when node_id is null then 'missing_exporter' when ds < shift
      then 'start_before_shift' when ls < ds then 'end_before_start' else 'reaches_back' end
      as reason, node_id, ds as delta_switched, ls as last_switched, dropped as dropped_windows
    from counted where node_id is null or ds < shift or ls < ds or dropped > 0""",
)
def quarantine(spark, sf_dir):
    return windowing.quarantine(tables.flows(spark, sf_dir), SHORT).select(
        "reason", "node_id", "delta_switched", "last_switched", "dropped_windows"
    )


RANGE_TEXT = "10.0.0.4/30, 10.0.0.17 , 10.0.0.20-10.0.0.25,10.0.1.0/24"


@register(
    "host_in_ranges",
    "select window_start, node_id, if_index, address, bytes_in, bytes_out"
    " from sum_exporter_interface_host where address <> '' and"
    " (cast(split_part(address, '.', 4) as integer) between 4 and 7"
    " or cast(split_part(address, '.', 4) as integer) = 17"
    " or cast(split_part(address, '.', 4) as integer) between 20 and 25)",
)
def host_in_ranges(spark, sf_dir):
    hosts = shape_sums(windowing.window_rows(tables.flows(spark, sf_dir), OPTIONS), [G.HOST])
    kept = ranges.in_ranges(hosts, "address", ranges.configured_ranges(spark, RANGE_TEXT))
    return kept.select("window_start", "node_id", "if_index", "address", "bytes_in", "bytes_out")


RANGE6_TEXT = "2001:db8::40-2001:DB8:0:0:0:0:0:7f, 2001:db8:1::/48, 2001:db8:0:2::1.2.3.4, 10.0.0.250-2001:db8::3"


@register(
    "ipv6_in_ranges",
    """select p, text from (select distinct l_partkey % 300 as p, l_linenumber % 4 as kind,
        case l_linenumber % 4 when 0 then '2001:db8::' || printf('%x', l_partkey % 300)
          when 1 then '2001:0DB8:' || printf('%x', l_partkey % 3) || ':0:0:0:0:' || printf('%04x', l_partkey % 300)
          when 2 then '::ffff:10.0.0.' || (l_partkey % 300)
          else '2001:db8:0:2::1.2.3.' || (l_partkey % 300) end as text from lineitem)
      where case kind when 0 then p <= 3 or p between 64 and 127
        when 1 then (p % 3 = 0 and (p <= 3 or p between 64 and 127)) or p % 3 = 1
        when 2 then p between 250 and 255 else p = 4 end""",
)
def ipv6_in_ranges(spark, sf_dir):
    """Addresses of both kinds in several spellings, and a range that goes from one to the other."""
    p, kind = (F.col("l_partkey") % 300).cast("bigint"), F.col("l_linenumber") % 4
    text = (
        F.when(kind == 0, F.format_string("2001:db8::%x", p))
        .when(kind == 1, F.format_string("2001:0DB8:%x:0:0:0:0:%04x", (F.col("l_partkey") % 3).cast("bigint"), p))
        .when(kind == 2, F.format_string("::ffff:10.0.0.%d", p))
        .otherwise(F.format_string("2001:db8:0:2::1.2.3.%d", p))
    )
    found = tables.table(spark, sf_dir, "lineitem").select(p.alias("p"), text.alias("text")).distinct()
    return ranges.in_ranges(found, "text", ranges.configured_ranges(spark, RANGE6_TEXT))


@register(
    "parse_ranges",
    """, texts as (select s_suppkey as id, s_suppkey % 256 as o, 8 + s_suppkey % 25 as bits
      from supplier)
    , pieces as (
      select id, cast(167772160 as bigint) + o * 65536 + 5 * 256 + o as low,
        cast(167772160 as bigint) + o * 65536 + 5 * 256 + o as high from texts
      union all select id, cast(167772160 as bigint) + o, cast(167772160 as bigint) + 16777215 from texts
      union all select id,
        ((cast(2885681152 as bigint) + o * 65536 + o * 257) // cast(2 ** (32 - bits) as bigint))
          * cast(2 ** (32 - bits) as bigint),
        ((cast(2885681152 as bigint) + o * 65536 + o * 257) // cast(2 ** (32 - bits) as bigint))
          * cast(2 ** (32 - bits) as bigint) + cast(2 ** (32 - bits) as bigint) - 1 from texts)
    select id, cast(low as bigint) as low, cast(high as bigint) as high from pieces""",
)
def parse_ranges(spark, sf_dir):
    octet = F.col("s_suppkey") % 256
    texts = tables.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.format_string(
            " 10.%d.5.%d,10.0.0.%d - 10.255.255.255, ,172.%d.%d.%d/%d",
            octet, octet, octet, octet, octet, octet, 8 + F.col("s_suppkey") % 25,
        ).alias("text"),
    )
    split = ranges.parse_ranges(texts, "text", keep=["id"])
    number = {n: F.conv(F.hex(n), 16, 10).cast("bigint").alias(n) for n in ("low", "high")}
    return split.select("id", number["low"], number["high"])


@register(
    "grouped_by_key",
    "select grouped_by, grouped_by_key, count(*) as n from summaries group by all",
)
def grouped_by_key(spark, sf_dir):
    from netrill.plans.summaries import build_summaries

    rows = build_summaries(tables.flows(spark, sf_dir), OPTIONS)
    return rows.groupBy("grouped_by", "grouped_by_key").agg(F.count("*").alias("n"))


@register(
    "conversation_key",
    "select location, protocol, address, larger_address, application, concat('[',"
    " to_json(location), ',', coalesce(cast(protocol as varchar), 'null'), ',', to_json(address),"
    " ',', to_json(larger_address), ',', to_json(application), ']') as conversation_key"
    " from numbered group by all",
)
def conversation_key(spark, sf_dir):
    columns = ["location", "protocol", "address", "larger_address", "application"]
    distinct = _canonical(spark, sf_dir).filter(F.col("node_id").isNotNull()).select(*columns)
    key = keys.conversation_key(*[F.col(name) for name in columns])
    return distinct.distinct().withColumn("conversation_key", key)


