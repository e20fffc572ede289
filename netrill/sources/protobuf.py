"""Flow records as protobuf messages in a binary column.

Batches of messages are read and written field by field over Arrow columns. What is
not in the plain form that writers of this message use (a field twice, unknown or
longer than usual, a text that is not UTF-8) is decoded by the ``protobuf`` package,
which the executors need. A message that does not parse becomes a row with an error
text instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from netrill.schema import FLOW_SCHEMA

# Numbers and kinds of the message fields that are read. A plain
# scalar has no presence; a "wrapped" one is a message around a value, and may
# be missing.
FLOW_FIELDS = (
    ("num_bytes", 2, "wrapped uint64"),
    ("direction", 3, "direction"),
    ("dst_address", 4, "string"),
    ("dst_hostname", 5, "string"),
    ("delta_switched", 11, "wrapped uint64"),
    ("first_switched", 12, "wrapped uint64"),
    ("last_switched", 13, "wrapped uint64"),
    ("input_snmp_ifindex", 17, "wrapped uint32"),
    ("output_snmp_ifindex", 18, "wrapped uint32"),
    ("protocol", 22, "wrapped uint32"),
    ("sampling_interval", 24, "wrapped double"),
    ("src_address", 26, "string"),
    ("src_hostname", 27, "string"),
    ("exporter_node", 36, "node"),
    ("application", 38, "string"),
    ("location", 40, "string"),
    ("dscp", 46, "wrapped uint32"),
    ("ecn", 47, "wrapped uint32"),
)
NODE_FIELDS = (("foreign_source", 1, "string"), ("foreign_id", 2, "string"), ("node_id", 3, "uint32"))
DIRECTIONS = ("INGRESS", "EGRESS")

PLAIN_TEXTS = [name for name, _, kind in FLOW_FIELDS if kind == "string"]
WRAPPED = [name for name, _, kind in FLOW_FIELDS if kind.startswith("wrapped")]
DECODED_SCHEMA = T.StructType(
    [
        *FLOW_SCHEMA.fields,
        T.StructField("decode_error", T.StringType()),
        # Of messages that could not be decoded only.
        T.StructField("payload", T.BinaryType()),
    ]
)


def message_class():
    """The record's message type, built from the field table."""
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory, wrappers_pb2

    field = descriptor_pb2.FieldDescriptorProto
    plain = {"string": field.TYPE_STRING, "uint32": field.TYPE_UINT32}
    wrapper = {"uint64": "UInt64Value", "uint32": "UInt32Value", "double": "DoubleValue"}
    pool = descriptor_pool.DescriptorPool()
    pool.AddSerializedFile(wrappers_pb2.DESCRIPTOR.serialized_pb)
    proto = descriptor_pb2.FileDescriptorProto(
        name="netrill_flow.proto", package="netrill", syntax="proto3"
    )
    proto.dependency.append(wrappers_pb2.DESCRIPTOR.name)
    enum = proto.enum_type.add(name="Direction")
    for number, name in enumerate(DIRECTIONS):
        enum.value.add(name=name, number=number)
    for message_name, table in (("Node", NODE_FIELDS), ("Flow", FLOW_FIELDS)):
        message = proto.message_type.add(name=message_name)
        for name, number, kind in table:
            added = message.field.add(name=name, number=number, label=field.LABEL_OPTIONAL)
            if kind in plain:
                added.type = plain[kind]
            elif kind == "direction":
                added.type, added.type_name = field.TYPE_ENUM, ".netrill.Direction"
            elif kind == "node":
                added.type, added.type_name = field.TYPE_MESSAGE, ".netrill.Node"
            else:
                added.type = field.TYPE_MESSAGE
                added.type_name = f".google.protobuf.{wrapper[kind.split()[1]]}"
    pool.Add(proto)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName("netrill.Flow"))


def _signed(value: int | None, bits: int) -> int | None:
    """Unsigned wire values in Spark's signed columns keep their bits."""
    return value - (1 << bits) if value is not None and value >> (bits - 1) else value


def _record(flow, payload: bytes) -> tuple:
    flow.ParseFromString(payload)
    values = {name: getattr(flow, name) for name in PLAIN_TEXTS}
    for name in WRAPPED:
        present = flow.HasField(name)
        values[name] = getattr(flow, name).value if present else None
    values["direction"] = "INGRESS" if flow.direction == 0 else "EGRESS"
    node = flow.exporter_node if flow.HasField("exporter_node") else None
    for name, _, _ in NODE_FIELDS:
        values[name] = getattr(node, name) if node is not None else None
    for entry in FLOW_SCHEMA.fields:
        if isinstance(entry.dataType, T.IntegerType):
            values[entry.name] = _signed(values[entry.name], 32)
        elif isinstance(entry.dataType, T.LongType):
            values[entry.name] = _signed(values[entry.name], 64)
    return tuple(values[name] for name in FLOW_SCHEMA.names)


def _decoded_singly(payloads: list[bytes | None]) -> pa.RecordBatch:
    from google.protobuf.message import DecodeError

    make, blank, rows = message_class(), (None,) * len(FLOW_SCHEMA), []
    for payload in payloads:
        try:
            rows.append((*_record(make(), payload), None, None))
        except (DecodeError, TypeError) as error:
            rows.append((*blank, str(error) or "malformed message", payload))
    schema = to_arrow_schema(DECODED_SCHEMA)
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _tags(fields) -> dict[str, int]:
    """The tag of each field in its usual wire type: a number for the direction and `uint32`, else bytes."""
    return {name: number << 3 | (0 if kind in ("direction", "uint32") else 2) for name, number, kind in fields}


class _Texts:
    """Values of a binary or string column as bytes with their begins and ends."""

    def __init__(self, column: pa.Array):
        kind = np.int64 if pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type) else np.int32
        _, offsets, data = column.buffers()
        found = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        self.begin, self.end = found[:-1], found[1:]
        held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        # Reads behind the last value see zeros.
        self.data = np.concatenate([held[: found[-1]], np.zeros(16, np.uint8)])


def _gathered(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each piece in turn, and the offsets of the pieces there."""
    offsets = np.concatenate([[0], np.cumsum(size)])
    return data[np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])], offsets


def _binary(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
    return pa.Array.from_buffers(kind, len(offsets) - 1, buffers)


def _varints(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that fill their pieces exactly, and which pieces are such; empty ones are 0."""
    values, good = np.zeros(len(begin), np.uint64), size <= 9
    for at in range(int(min(size.max(initial=0), 9))):
        inside = at < size
        byte = data[np.where(inside, begin + at, 0)]
        good &= ~inside | ((byte >= 128) == (at + 1 < size))
        values |= np.where(inside, (byte & 127).astype(np.uint64) << np.uint64(7 * at), np.uint64(0))
    return values, good


def _split(data: np.ndarray, begin: np.ndarray, end: np.ndarray, tags: dict[str, int]):
    """Begin and size of each field's content in messages that hold it once, and which messages are such.

    A begin of -1 is a missing field. All messages go on by one field a step.
    """
    names = list(tags)
    number_of = np.full(1 << 14, -1, np.int64)
    for number, name in enumerate(names):
        number_of[tags[name]] = number
    begins = np.full((len(names), len(begin)), -1, np.int64)
    sizes = np.zeros((len(names), len(begin)), np.int64)
    good, at, left = np.ones(len(begin), bool), begin.copy(), np.flatnonzero(begin < end)

    def short(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of one or two bytes, the places behind them, and which are such."""
        low, high = data[place].astype(np.int64), data[place + 1].astype(np.int64)
        two = low >= 128
        return np.where(two, low & 127 | high << 7, low), place + 1 + two, ~two | ((high > 0) & (high < 128))

    while len(left):
        tag, place, plain = short(at[left])
        field = number_of[np.where(plain, tag, 0)]
        plain &= field >= 0
        number, content, fits = short(np.minimum(place, len(data) - 2))
        sized = (tag & 7) == 2
        size = np.where(sized, number, 0)
        follows = np.where(sized, content + size, place)
        # A plain number's size is found by its bytes.
        bare = np.flatnonzero(plain & ~sized)
        if len(bare):
            run, open_ = follows[bare], np.ones(len(bare), bool)
            for _ in range(5):
                byte = data[np.minimum(run, len(data) - 1)]
                run, open_ = run + open_, open_ & (byte >= 128)
            follows[bare] = run
            plain[bare] &= ~open_
            content, size = np.where(sized, content, place), np.where(sized, size, follows - place)
        plain &= (fits | ~sized) & (follows <= end[left])
        plain &= begins[np.maximum(field, 0), left] < 0
        good[left[~plain]] = False
        left, field = left[plain], field[plain]
        begins[field, left], sizes[field, left], at[left] = content[plain], size[plain], follows[plain]
        left = left[at[left] < end[left]]
    return dict(zip(names, begins)), dict(zip(names, sizes)), good


def _decoded(payloads: pa.Array) -> Iterator[pa.RecordBatch]:
    held = _Texts(payloads)
    data, rows = held.data, len(payloads)
    begins, sizes, good = _split(data, held.begin, held.end, _tags(FLOW_FIELDS))
    if payloads.null_count:
        good &= payloads.is_valid().to_numpy(zero_copy_only=False)
    values: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    kinds = {entry.name: entry.type for entry in to_arrow_schema(FLOW_SCHEMA)}
    for name, _, kind in FLOW_FIELDS:
        if not kind.startswith("wrapped"):
            continue
        begin, size = begins[name], sizes[name]
        some = size > 0
        inner = np.where(some, data[np.maximum(begin, 0)], 0)
        if kind.endswith("double"):
            good &= ~some | ((inner == 9) & (size == 9))
            eight = np.where(some, begin + 1, 0)[:, None] + np.arange(8)
            found = np.where(some, data[np.minimum(eight, len(data) - 1)].view("<f8")[:, 0], 0.0)
        else:
            number, exact = _varints(data, begin + 1, np.maximum(size - 1, 0))
            good &= ~some | ((inner == 8) & exact & (size > 1))
            if kind.endswith("uint32"):
                good &= number < 1 << 32
                found = number.astype(np.uint32).view(np.int32)
            else:
                found = number.view(np.int64)
        values[name] = found, begin >= 0
    way, exact = _varints(data, begins["direction"], sizes["direction"])
    good &= exact
    texts = {name: (begins[name], sizes[name], np.ones(rows, bool)) for name in PLAIN_TEXTS}
    node, there = begins["exporter_node"], begins["exporter_node"] >= 0
    start = np.where(there, node, 0)
    inside, lengths, fine = _split(data, start, start + sizes["exporter_node"], _tags(NODE_FIELDS))
    good &= fine
    for name, _, kind in NODE_FIELDS:
        if kind == "string":
            texts[name] = inside[name], lengths[name], there
        else:
            number, exact = _varints(data, inside[name], lengths[name])
            good &= exact & (number < 1 << 32)
            values[name] = number.astype(np.uint32).view(np.int32), there
    kept = np.flatnonzero(good)
    columns = {}
    for name, (found, present) in values.items():
        columns[name] = pa.array(found[kept], kinds[name], mask=~present[kept])
    columns["direction"] = pc.if_else(pa.array(way[kept] == 0), DIRECTIONS[0], DIRECTIONS[1])
    for name, (begin, size, present) in texts.items():
        column = _binary(*_gathered(data, begin[kept], size[kept]), pa.string())
        try:
            column.validate(full=True)
        except pa.ArrowInvalid:
            yield _decoded_singly(payloads.to_pylist())
            return
        columns[name] = column if present[kept].all() else pc.if_else(pa.array(present[kept]), column, None)
    if len(kept):
        columns["decode_error"], columns["payload"] = pa.nulls(len(kept), pa.string()), pa.nulls(len(kept), pa.binary())
        schema = to_arrow_schema(DECODED_SCHEMA)
        yield pa.RecordBatch.from_arrays([columns[name] for name in schema.names], schema=schema)
    if len(kept) < rows:
        yield _decoded_singly(payloads.filter(pa.array(~good)).to_pylist())


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield from _decoded(batch.column(0))


def decode_flows(messages: DataFrame, value: str = "value") -> DataFrame:
    """Flow columns of the messages in a binary column; ``decode_error`` and ``payload`` of bad ones."""
    return messages.select(F.col(value).alias("value")).mapInArrow(_decode, DECODED_SCHEMA)


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("decode_error").isNull()).drop("decode_error", "payload")


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("decode_error").isNotNull()).select("decode_error", "payload")


def _wire(numbers: np.ndarray) -> pa.Array:
    """Each number as a varint."""
    numbers = numbers.astype(np.uint64)
    size = np.ones(len(numbers), np.int64)
    for bits in range(7, 64, 7):
        size += numbers >= np.uint64(1 << bits)
    offsets = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(offsets[-1], np.uint8)
    for at in range(int(size.max(initial=0))):
        some = np.flatnonzero(size > at)
        byte = (numbers[some] >> np.uint64(7 * at)).astype(np.uint8) & 127
        out[offsets[some] + at] = byte | np.where(size[some] > at + 1, 128, 0).astype(np.uint8)
    return _binary(out, offsets, pa.binary())


def _joined(*parts: pa.Array | bytes) -> pa.Array:
    parts = [pa.scalar(part, pa.binary()) if isinstance(part, bytes) else part for part in parts]
    return pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.binary()))


def _field(number: int, content: pa.Array, present: np.ndarray) -> pa.Array:
    """Tag, size and content where the field is present, else nothing."""
    tag = _wire(np.array([number << 3 | 2]))[0].as_py()
    size = _wire(pc.binary_length(content).to_numpy(zero_copy_only=False))
    return pc.if_else(pa.array(present), _joined(tag, size, content), pa.scalar(b"", pa.binary()))


def _unsigned(column: pa.Array, bits: int, wrapped: bool = True) -> np.ndarray:
    filled = column.fill_null(0).to_numpy(zero_copy_only=False)
    if wrapped and filled.min(initial=0) < 0:
        raise ValueError(f"Value out of range: {filled.min()}")
    return filled.view(np.uint64 if bits == 64 else np.uint32).astype(np.uint64)


def _messages(batch: pa.RecordBatch) -> pa.Array:
    """The messages of a batch of flow records; values of their type's default are left out."""
    nothing = pa.scalar(b"", pa.binary())

    def valid(name: str) -> np.ndarray:
        return batch.column(name).is_valid().to_numpy(zero_copy_only=False)

    def text(number: int, name: str) -> pa.Array:
        content = batch.column(name).cast(pa.binary()).fill_null(b"")
        return _field(number, content, pc.binary_length(content).to_numpy(zero_copy_only=False) > 0)

    parts = []
    for name, number, kind in FLOW_FIELDS:
        if kind == "string":
            parts.append(text(number, name))
        elif kind == "wrapped double":
            held = batch.column(name).fill_null(0.0).to_numpy(zero_copy_only=False).astype("<f8")
            bits = held.view(np.uint64)
            eight = _binary(bits.view(np.uint8), np.arange(batch.num_rows + 1) * 8, pa.binary())
            content = pc.if_else(pa.array(bits != 0), _joined(b"\x09", eight), nothing)
            parts.append(_field(number, content, valid(name) & ~np.isnan(held)))
        elif kind.startswith("wrapped"):
            value = _unsigned(batch.column(name), 64 if kind.endswith("64") else 32)
            content = pc.if_else(pa.array(value != 0), _joined(b"\x08", _wire(value)), nothing)
            parts.append(_field(number, content, valid(name)))
        elif kind == "direction":
            plain = pc.fill_null(pc.equal(batch.column(name), DIRECTIONS[0]), True)
            parts.append(pc.if_else(plain, nothing, pa.scalar(bytes([number << 3, 1]), pa.binary())))
        else:
            value = _unsigned(batch.column("node_id"), 32, wrapped=False)
            tag = bytes([NODE_FIELDS[2][1] << 3])
            own = pc.if_else(pa.array(value != 0), _joined(tag, _wire(value)), nothing)
            inside = _joined(*[text(place, part) for part, place, form in NODE_FIELDS if form == "string"], own)
            parts.append(_field(number, inside, valid("node_id")))
    return _joined(*parts)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([_messages(batch)], ["value"])


def encode_flows(flows: DataFrame) -> DataFrame:
    """The reverse of ``decode_flows``."""
    columns = [F.col(name) for name in FLOW_SCHEMA.names]
    return flows.select(*columns).mapInArrow(_encode, "value binary")
