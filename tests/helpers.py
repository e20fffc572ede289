"""Hand-made flows, with the defaults most cases share."""

from netrill.schema import FLOW_SCHEMA

DEFAULTS = {
    "node_id": 99,
    "foreign_source": "plant",
    "foreign_id": "edge-7",
    "direction": "INGRESS",
    "input_snmp_ifindex": 98,
    "output_snmp_ifindex": None,
    "dscp": 0,
    "ecn": 0,
    "application": "mail",
    "protocol": 6,
    "location": "",
    "src_address": "10.0.0.1",
    "dst_address": "10.0.0.2",
    "src_hostname": "",
    "dst_hostname": "",
    "num_bytes": 0,
    "sampling_interval": 1.0,
}


def flow(start, end, num_bytes, **more):
    """One record; the first packet is the start unless said otherwise."""
    times = {"first_switched": start, "delta_switched": start, "last_switched": end}
    return {**DEFAULTS, **times, "num_bytes": num_bytes, **more}


def flows(spark, records):
    rows = [tuple(record[name] for name in FLOW_SCHEMA.names) for record in records]
    return spark.createDataFrame(rows, FLOW_SCHEMA)


def shift(node_id, window_ms):
    """Window phase, computed independently of Spark."""
    h = (node_id * -1640531527) & 0xFFFFFFFF
    h ^= h >> 16
    return abs(h - (1 << 32) if h >= 1 << 31 else h) % window_ms


def window_start(node_id, window_ms, ts):
    phase = shift(node_id, window_ms)
    return ts - (ts - phase) % window_ms
