"""Messages are read and written by columns; the protobuf package decodes only what is out of the usual form."""

import random

import pyarrow as pa
import pytest
from helpers import flow
from netrill.config import FlowOptions
from netrill.schema import FLOW_SCHEMA
from netrill.sources import kafka, protobuf
from netrill.streaming import quarantine
from pyspark.sql.pandas.types import to_arrow_schema


def _records():
    odd = {name: None for name in FLOW_SCHEMA.names if name not in ("location", "src_address", "dst_address")}
    return [
        flow(0, 9, 2**63 - 1, node_id=-1, sampling_interval=0.0, src_hostname="é" * 200),
        flow(2**56, 2**56 + 5, 7, direction="EGRESS", ecn=0, protocol=2**31 - 1, sampling_interval=2.5),
        flow(1, 2, 0, **{k: v for k, v in odd.items() if k not in ("direction", "num_bytes")}),
    ]


def _encoded():
    batch = pa.RecordBatch.from_pylist(_records(), to_arrow_schema(FLOW_SCHEMA))
    return [value for part in protobuf._encode(iter([batch])) for value in part.column(0).to_pylist()]


def _read(payloads):
    batch = pa.record_batch({"value": pa.array([b"", *payloads], pa.binary())}).slice(1)
    return [tuple(row.values()) for part in protobuf._decode(iter([batch])) for row in part.to_pylist()]


def test_usual_messages_are_read_and_written_by_columns(monkeypatch):
    def refuse():
        raise AssertionError("decoded or encoded one by one")

    monkeypatch.setattr(protobuf, "message_class", refuse)
    got = {row[:20] for row in _read(_encoded())}
    plain = lambda name, value: "" if value is None and name in protobuf.PLAIN_TEXTS else value
    wanted = []
    for record in _records():
        row = {name: plain(name, record[name]) for name in FLOW_SCHEMA.names}
        row["direction"] = row["direction"] or "INGRESS"
        if row["node_id"] is None:
            row["foreign_source"] = row["foreign_id"] = None
        wanted.append(tuple(row.values()))
    assert got == set(wanted)


def test_any_message_is_read_as_the_package_reads_it():
    rng, usual = random.Random(5), _encoded()
    found = [None, b"", b"\xff" * 20, b"\x00", *usual, usual[0] + usual[1], usual[1] + b"\xfa\x03\x01x"]
    for _ in range(1500):
        message = bytearray(rng.choice(usual))
        at = rng.randrange(len(message))
        kind = rng.randrange(3)
        if kind:
            message[at : at + kind - 1] = bytes([rng.randrange(256)])
        else:
            del message[at:]
        found.append(bytes(message))
    for at in range(0, len(found), 5):
        part = found[at : at + 5]
        singly = [tuple(row.values()) for row in protobuf._decoded_singly(part).to_pylist()]
        assert sorted(map(str, _read(part))) == sorted(map(str, singly))


def test_numbers_below_zero_are_refused():
    batch = pa.RecordBatch.from_pylist([flow(0, 9, -5)], to_arrow_schema(FLOW_SCHEMA))
    with pytest.raises(ValueError, match="out of range"):
        list(protobuf._encode(iter([batch])))


def _plan(frame):
    return frame._jdf.queryExecution().analyzed().toString()


def test_message_stream_is_decoded_by_columns(spark, tmp_path):
    stream = kafka.flow_stream(spark, FlowOptions(), str(tmp_path))
    assert stream.isStreaming and _plan(stream).count("MapInArrow") == 1


def test_quarantine_decodes_once_and_keeps_nothing_in_memory(spark):
    messages = spark.createDataFrame([(bytearray(b"\xff"),), (bytearray(_encoded()[2]),)], "value binary")
    left = quarantine.left_out(protobuf.decode_flows(messages), FlowOptions())
    assert _plan(left).count("MapInArrow") == 1
    assert sorted((r.reason, r.payload is None, r.flow is None) for r in left.collect()) == [
        ("malformed", False, True),
        ("missing_exporter", True, False),
    ]
