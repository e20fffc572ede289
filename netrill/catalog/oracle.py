"""The same results as DuckDB SQL over the driver's tables.

Written out on its own, without the package's plans, so that a mistake in one
does not repeat in the other. Only the flow view is shared.
"""

from __future__ import annotations

from netrill.sources.tables import flows_sql

ITF = "node_id, foreign_source, foreign_id, if_index"
CONV = "location, protocol, address, larger_address, application"
FLAGS = (
    "bool_or(congestion_encountered) as congestion_encountered, bool_or(non_ect) as non_ect"
)
SUMS = f"cast(sum(bytes_in) as bigint) as bytes_in, cast(sum(bytes_out) as bigint) as bytes_out, {FLAGS}"

# name: columns below the interface, parent columns below the interface, own key
APP_KEY, HOST_KEY = "application", "address"
CONV_KEY = (
    "concat('[', to_json(location), ',', coalesce(cast(protocol as varchar), 'null'), ',',"
    " to_json(address), ',', to_json(larger_address), ',', to_json(application), ']')"
)
SHAPES = {
    "EXPORTER_INTERFACE": ("", None, None),
    "EXPORTER_INTERFACE_TOS": ("dscp", None, None),
    "EXPORTER_INTERFACE_APPLICATION": ("application", "", APP_KEY),
    "EXPORTER_INTERFACE_TOS_APPLICATION": ("dscp, application", "dscp", APP_KEY),
    "EXPORTER_INTERFACE_HOST": ("address", "", HOST_KEY),
    "EXPORTER_INTERFACE_TOS_HOST": ("dscp, address", "dscp", HOST_KEY),
    "EXPORTER_INTERFACE_CONVERSATION": (CONV, "", CONV_KEY),
    "EXPORTER_INTERFACE_TOS_CONVERSATION": (f"dscp, {CONV}", "dscp", CONV_KEY),
}

RECORD_COLUMNS = f"""
  node_id,
  case when foreign_source <> '' and foreign_id <> '' then foreign_source end as foreign_source,
  case when foreign_source <> '' and foreign_id <> '' then foreign_id end as foreign_id,
  coalesce(case when direction = 'INGRESS' then input_snmp_ifindex else output_snmp_ifindex end, 0)
    as if_index,
  coalesce(dscp, 0) as dscp, location, protocol,
  case when src_address < dst_address then src_address else dst_address end as address,
  case when src_address < dst_address then dst_address else src_address end as larger_address,
  case when application = '' then '__unknown' else application end as application,
  nullif(case when src_address < dst_address then src_hostname else dst_hostname end, '')
    as hostname,
  nullif(case when src_address < dst_address then dst_hostname else src_hostname end, '')
    as hostname2,
  direction = 'INGRESS' as ingress,
  case when sampling_interval > 0 then sampling_interval else 1.0 end as multiplier,
  num_bytes * case when sampling_interval > 0 then sampling_interval else cast(1.0 as double) end
    as scaled_bytes,
  coalesce(ecn = 3, false) as congestion_encountered, ecn is null or ecn = 0 as non_ect
"""


def ctes(window_ms: int = 60_000, max_duration_ms: int = 900_000, k: int = 10) -> str:
    """Named steps from the flow view to the summaries."""
    w = window_ms
    parts = [
        ("flows", flows_sql()),
        (
            "mixed",
            f"""select *, xor(u, u >> 16) as m from (select *,
              coalesce(delta_switched, first_switched, 0) as ds, last_switched as ls,
              ((cast(coalesce(node_id, 0) as bigint) * (-1640531527)) % 4294967296 + 4294967296)
                % 4294967296 as u from flows)""",
        ),
        (
            "shifted",
            f"""select *, abs(case when m >= 2147483648 then m - 4294967296 else m end) % {w}
              as shift from mixed""",
        ),
        (
            "numbered",
            f"""select {RECORD_COLUMNS}, ds, ls, shift, (ds - shift) // {w} as first_n,
              (ls - shift) // {w} as last_n
              from shifted where node_id is not null and ds >= shift and ls >= ds""",
        ),
        (
            "exploded",
            "select *, unnest(range(first_n, last_n + 1)) as wn from numbered",
        ),
        (
            "emitted",
            f"""select * from (select *, least(ds + (wn - first_n) * {w}, ls) as emit_ts,
              shift + wn * {w} as window_start, shift + wn * {w} + {w} as window_end
              from exploded) where emit_ts > ls - {max_duration_ms}""",
        ),
        (
            "shared",
            """select *, cast(trunc((least(ls, window_end - 1) - ds + 1) * scaled_bytes
              / (ls - ds + 1)) as bigint) - cast(trunc((greatest(ds, window_start) - ds)
              * scaled_bytes / (ls - ds + 1)) as bigint) as share from emitted""",
        ),
        (
            "win",
            """select *, case when ingress then share else 0 end as bytes_in,
              case when ingress then 0 else share end as bytes_out from shared""",
        ),
        (
            "leaf",
            f"""select window_start, {ITF}, dscp, {CONV}, {SUMS}, min(hostname) as hostname,
              min(hostname2) as hostname2 from win group by all""",
        ),
        (
            "hosts",
            f"""select window_start, {ITF}, dscp, address, hostname, bytes_in, bytes_out,
              congestion_encountered, non_ect from leaf
              union all select window_start, {ITF}, dscp, larger_address, hostname2, bytes_in,
              bytes_out, congestion_encountered, non_ect from leaf""",
        ),
    ]
    for name, (columns, parent, own) in SHAPES.items():
        source = "hosts" if own == HOST_KEY else "leaf"
        extra = f", {columns}" if columns else ""
        host = ", min(hostname) as hostname" if own == HOST_KEY else ""
        parts.append(
            (
                f"sum_{name.lower()}",
                f"select window_start, {ITF}{extra}, {SUMS}{host} from {source} group by all",
            )
        )
        if own is not None:
            where = ""
            if own == CONV_KEY:
                where = (
                    " where location is not null and protocol is not null"
                    " and address <> '' and larger_address <> ''"
                )
            by = f"window_start, {ITF}" + (f", {parent}" if parent else "")
            parts.append(
                (
                    f"top_{name.lower()}",
                    f"""select * from (select *, {own} as own_key, row_number() over (
                      partition by {by} order by bytes_in + bytes_out desc, {own}) as ranking
                      from sum_{name.lower()}{where}) where ranking <= {k}""",
                )
            )
    parts.extend((f"out_{name.lower()}", summary_select(name, w)) for name in SHAPES)
    union = " union all ".join(f"select * from out_{name.lower()}" for name in SHAPES)
    parts.append(("summaries", union))
    return "with " + ",\n".join(f"{name} as ({text})" for name, text in parts)




def summary_select(name: str, w: int) -> str:
    columns, parent, own = SHAPES[name]
    total = own is None
    table = ("sum_" if total else "top_") + name.lower()
    has_dscp = columns.startswith("dscp")
    parts = ["case when foreign_source is null then cast(node_id as varchar)"
             " else foreign_source || ':' || foreign_id end", "cast(if_index as varchar)"]
    if has_dscp:
        parts.append("cast(dscp as varchar)")
    if own:
        parts.append("own_key")
    text = " || '-' || ".join(f"({part})" for part in parts)
    return f"""select window_start as range_start, window_start + {w} as range_end,
      '{name}' as grouped_by, '{"TOTAL" if total else "TOPK"}' as aggregation_type,
      bytes_in as bytes_ingress, bytes_out as bytes_egress, bytes_in + bytes_out as bytes_total,
      {"dscp" if has_dscp else "cast(null as integer)"} as dscp, congestion_encountered, non_ect,
      {ITF}, {"application" if own == APP_KEY else "cast(null as varchar)"} as application,
      {"address" if own == HOST_KEY else "cast(null as varchar)"} as host_address,
      {"hostname" if own == HOST_KEY else "cast(null as varchar)"} as host_name,
      {"own_key" if own == CONV_KEY else "cast(null as varchar)"} as conversation_key,
      {text} as grouped_by_key,
      {"cast(null as integer)" if total else "cast(ranking as integer)"} as ranking
      from {table}"""


def query(select: str, **parameters: int) -> str:
    return f"{ctes(**parameters)}\n{select}"
