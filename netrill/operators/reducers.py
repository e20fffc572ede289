"""One description of how values merge, for batch aggregates and for stream state.

A reducer lists fields with how each merges. From it come the aggregate columns of a
batch plan and the merge of Python state, so the two can't differ.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


@dataclass(frozen=True)
class Way:
    """How values of a field merge: as a column, over a pandas series, and two at a time."""

    column: Callable[[str], Column]
    series: Callable[[pd.Series], object]
    pair: Callable[[object, object], object]


# Each leaves missing values out; of nothing but missing ones comes a missing one.
WAYS = {
    "sum": Way(F.sum, lambda s: s.sum(), lambda a, b: a + b),
    "max": Way(F.max, lambda s: s.max(), max),
    "min": Way(F.min, lambda s: s.min(), min),
    "any": Way(F.bool_or, lambda s: s.any(), lambda a, b: a or b),
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: T.DataType
    way: str


@dataclass(frozen=True)
class Reducer:
    fields: tuple[Field, ...]

    @property
    def names(self) -> list[str]:
        return [field.name for field in self.fields]

    @property
    def schema(self) -> list[T.StructField]:
        return [T.StructField(field.name, field.kind) for field in self.fields]

    def columns(self) -> list[Column]:
        """Aggregates for a batch plan."""
        return [WAYS[f.way].column(f.name).cast(f.kind).alias(f.name) for f in self.fields]

    def of_frame(self, frame: pd.DataFrame) -> tuple:
        """All rows of a frame merged."""
        return tuple(self._plain(f, frame[f.name].dropna()) for f in self.fields)

    @staticmethod
    def _plain(field: Field, values: pd.Series) -> object:
        if not len(values):
            return None
        found = WAYS[field.way].series(values)
        cast = {T.LongType: int, T.IntegerType: int, T.BooleanType: bool, T.DoubleType: float}
        return cast.get(type(field.kind), lambda x: x)(found)

    def merge(self, left: Sequence, right: Sequence) -> tuple:
        out = []
        for field, a, b in zip(self.fields, left, right, strict=True):
            missing = a is None or b is None
            out.append((b if a is None else a) if missing else WAYS[field.way].pair(a, b))
        return tuple(out)


def sums_and_flags(*names: str) -> Reducer:
    """Bytes add up, flags hold if any does, of names the smallest present one stays."""
    return Reducer(
        (
            Field("bytes_in", T.LongType(), "sum"),
            Field("bytes_out", T.LongType(), "sum"),
            Field("congestion_encountered", T.BooleanType(), "any"),
            Field("non_ect", T.BooleanType(), "any"),
            *[Field(name, T.StringType(), "min") for name in names],
        )
    )


LEAF = sums_and_flags("hostname", "hostname2")
SERIES = sums_and_flags("hostname")
