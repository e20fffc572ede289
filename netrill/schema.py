"""Record shapes: flow input, flow summaries, metric samples."""

from __future__ import annotations

from pyspark.sql import types as T

# The flat columns of a flow record that computations read.
FLOW_SCHEMA = T.StructType(
    [
        T.StructField("node_id", T.IntegerType()),
        T.StructField("foreign_source", T.StringType()),
        T.StructField("foreign_id", T.StringType()),
        T.StructField("direction", T.StringType()),
        T.StructField("input_snmp_ifindex", T.IntegerType()),
        T.StructField("output_snmp_ifindex", T.IntegerType()),
        T.StructField("dscp", T.IntegerType()),
        T.StructField("ecn", T.IntegerType()),
        T.StructField("application", T.StringType()),
        T.StructField("protocol", T.IntegerType()),
        T.StructField("location", T.StringType()),
        T.StructField("src_address", T.StringType()),
        T.StructField("dst_address", T.StringType()),
        T.StructField("src_hostname", T.StringType()),
        T.StructField("dst_hostname", T.StringType()),
        T.StructField("num_bytes", T.LongType()),
        T.StructField("sampling_interval", T.DoubleType()),
        T.StructField("first_switched", T.LongType()),
        T.StructField("delta_switched", T.LongType()),
        T.StructField("last_switched", T.LongType()),
    ]
)

EXPORTER_COLUMNS = ("node_id", "foreign_source", "foreign_id")
CONVERSATION_COLUMNS = (
    "location",
    "protocol",
    "address",
    "larger_address",
    "application",
)
BYTE_COLUMNS = ("bytes_in", "bytes_out")
FLAG_COLUMNS = ("congestion_encountered", "non_ect")

# Output documents carry these names.
SUMMARY_COLUMNS = (
    "range_start",
    "range_end",
    "grouped_by",
    "aggregation_type",
    "bytes_ingress",
    "bytes_egress",
    "bytes_total",
    "dscp",
    "congestion_encountered",
    "non_ect",
    "node_id",
    "foreign_source",
    "foreign_id",
    "if_index",
    "application",
    "host_address",
    "host_name",
    "conversation_key",
    "grouped_by_key",
    "ranking",
)

UNKNOWN_APPLICATION = "__unknown"
