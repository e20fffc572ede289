"""Merging of byte sums, names and flags, by one or by several key shapes.

Byte sums and flags live in fixed-width buffers and run as hash aggregates.
``min`` over a string cannot, and sorts its whole input instead, so names ride
along as a grouping column until the rows are few.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from netrill.schema import BYTE_COLUMNS, EXPORTER_COLUMNS, FLAG_COLUMNS

BASE_COLUMNS = ("window_start", *EXPORTER_COLUMNS, "if_index")
VALUES = (*BYTE_COLUMNS, *FLAG_COLUMNS)


def merged_values(more_flags: Sequence[str] = ()) -> list[Column]:
    sums = [F.sum(name).alias(name) for name in BYTE_COLUMNS]
    return sums + [F.bool_or(name).alias(name) for name in (*FLAG_COLUMNS, *more_flags)]


def merged_names(*names: str) -> list[Column]:
    """Smallest of the present names; missing ones are null and ignored."""
    return [F.min(name).alias(name) for name in names]


def digest(columns: Sequence[str]) -> Column:
    """A number that differs for nearly all different keys.

    As the first of a key's columns it decides nearly every comparison of a sort, and Spark
    compares a first column that is a number without reading the rows. The others still count.
    """
    return F.xxhash64(*columns)


def merge_by(rows: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Merge the rows of equal key. Names make it a sort, so the key's digest comes first."""
    merged = rows.withColumn("digest", digest(keys)).groupBy("digest", *keys)
    return merged.agg(*merged_values(), *merged_names(*names)).drop("digest")


def sum_by(rows: DataFrame, columns: Sequence[str], names: Sequence[str] = ()) -> DataFrame:
    """Merge the rows of equal key and window."""
    keys = ["window_start", *columns]
    if names:
        return merge_by(rows, keys, names)
    return rows.groupBy(*keys).agg(*merged_values())


def sum_shapes(
    rows: DataFrame,
    base: Sequence[str],
    shapes: Mapping[str, Sequence[str]],
    label: str,
    names: Sequence[str] = (),
    flags: Sequence[str] = (),
) -> DataFrame:
    """Merge the rows once per key shape, all in one pass and one shuffle.

    A shape is a list of columns besides ``base``; ``label`` holds its name.
    The label is an aggregate, not a grouping column: a filter on it stays
    above the shuffle, so branches that read different shapes share it.
    """
    extra = list(dict.fromkeys(name for shape in shapes.values() for name in shape))
    columns = [*base, *extra]
    sets = [[F.col(name) for name in (*base, *shape)] for shape in shapes.values()]
    names_of_sets = []
    for name, shape in shapes.items():
        number = 0
        for column in columns:
            number = number * 2 + (column not in (*base, *shape))
        names_of_sets.append(F.when(F.col(label) == number, F.lit(name)))
    merged = rows.groupingSets(sets, *[F.col(name) for name in columns]).agg(
        F.max(F.grouping_id()).alias(label), *merged_values(flags), *merged_names(*names)
    )
    return merged.withColumn(label, F.coalesce(*names_of_sets))


def with_endpoints(rows: DataFrame) -> DataFrame:
    """Two rows per conversation, one per endpoint with its own name.

    A conversation of a host with itself yields that host twice.
    """
    endpoints = F.array(
        F.struct(F.col("address"), F.col("hostname")),
        F.struct(F.col("larger_address").alias("address"), F.col("hostname2").alias("hostname")),
    )
    kept = [name for name in rows.columns if name not in ("address", "hostname", "hostname2")]
    return rows.withColumn("endpoint", F.explode(endpoints)).select(
        *kept, F.col("endpoint.address").alias("address"), F.col("endpoint.hostname").alias("hostname")
    )
