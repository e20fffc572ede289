"""Names, labels and sizes of metric samples."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

METRIC_NAME_LABEL = "__name__"


def sanitize_metric_name(name: Column) -> Column:
    cleaned = F.regexp_replace(name, "[^A-Za-z0-9_:]", "_")
    return F.regexp_replace(cleaned, "^[0-9]", "_")


def sanitize_label_name(name: Column) -> Column:
    cleaned = F.regexp_replace(name, "[^A-Za-z0-9_]", "_")
    return F.regexp_replace(cleaned, "^[0-9]", "_")


def _varint_size(number: Column) -> Column:
    """Bytes of a non-negative number written seven bits at a time."""
    size = F.lit(1)
    for bits in range(7, 63, 7):
        size = size + F.when(number >= F.lit(1 << bits), 1).otherwise(0)
    return size


def _framed(size: Column) -> Column:
    """A one-byte tag, the length, the content."""
    return F.lit(1) + _varint_size(size) + size


def _text_size(text: Column) -> Column:
    size = F.octet_length(text)
    return F.when(size == 0, 0).otherwise(_framed(size))


def series_bytes(labels: Column, ts_ms: Column, value: Column) -> Column:
    """Serialised size of a series with one sample in the remote-write format."""
    label_sizes = F.transform(
        F.map_entries(labels), lambda e: _framed(_text_size(e["key"]) + _text_size(e["value"]))
    )
    total = F.aggregate(label_sizes, F.lit(0), lambda acc, size: acc + size)
    number = F.when(value == 0, 0).otherwise(9)
    moment = F.when(ts_ms == 0, 0).otherwise(F.lit(1) + _varint_size(ts_ms))
    return total + _framed(number + moment)
