"""Flow records to normalised records: defaults, identities, endpoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from netrill.functions import records, windows
from netrill.schema import CONVERSATION_COLUMNS, EXPORTER_COLUMNS, FLAG_COLUMNS


def with_delta(flows: DataFrame) -> DataFrame:
    """Fill a missing start from the first packet's time."""
    filled = records.delta_or_first(F.col("delta_switched"), F.col("first_switched"))
    return flows.withColumn("delta_switched", filled)


def with_shift(flows: DataFrame, window_ms: int) -> DataFrame:
    """Add the exporter's window phase; a missing exporter counts as node 0."""
    node = F.coalesce(F.col("node_id"), F.lit(0))
    return flows.withColumn("shift", windows.node_shift(node, window_ms))


def canonical(flows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Project every field a grouping or an aggregate needs, normalised, and what is in ``keep``.

    A conversation has no direction: its smaller address comes first and the
    host names follow their addresses.
    """
    src, dst = records.text(F.col("src_address")), records.text(F.col("dst_address"))
    smaller = records.source_is_smaller(F.col("src_address"), F.col("dst_address"))
    src_name = records.name_or_null(F.col("src_hostname"))
    dst_name = records.name_or_null(F.col("dst_hostname"))
    multiplier = records.sampling_multiplier(F.col("sampling_interval"))
    fs, fid = F.col("foreign_source"), F.col("foreign_id")
    columns = {
        "node_id": F.col("node_id"),
        "foreign_source": records.both_present(fs, fid),
        "foreign_id": records.both_present(fid, fs),
        "if_index": records.interface_index(
            F.col("direction"), F.col("input_snmp_ifindex"), F.col("output_snmp_ifindex")
        ),
        "dscp": records.dscp_or_default(F.col("dscp")),
        "location": F.col("location"),
        "protocol": F.col("protocol"),
        "address": F.when(smaller, src).otherwise(dst),
        "larger_address": F.when(smaller, dst).otherwise(src),
        "application": records.application_or_unknown(F.col("application")),
        "hostname": F.when(smaller, src_name).otherwise(dst_name),
        "hostname2": F.when(smaller, dst_name).otherwise(src_name),
        "ingress": records.is_ingress(F.col("direction")),
        "scaled_bytes": F.coalesce(F.col("num_bytes"), F.lit(0)).cast("double") * multiplier,
        "congestion_encountered": records.congestion_encountered(F.col("ecn")),
        "non_ect": records.non_ecn_capable(F.col("ecn")),
        "delta_switched": F.col("delta_switched"),
        "last_switched": F.coalesce(F.col("last_switched"), F.lit(0).cast("bigint")),
        "shift": F.col("shift"),
    }
    more = [name for name in keep if name not in columns]
    return flows.select(*[value.alias(name) for name, value in columns.items()], *more)


KEY_COLUMNS = (*EXPORTER_COLUMNS, "if_index", "dscp", *CONVERSATION_COLUMNS)
VALUE_COLUMNS = ("hostname", "hostname2", *FLAG_COLUMNS)
