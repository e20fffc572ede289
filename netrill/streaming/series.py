"""Per-key state that Spark's built-in aggregates cannot express.

All three operators keep one small state row per key in Spark's state store:
the panes of one window and key, or the pane slots of one series.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from netrill.config import FlowOptions
from netrill.operators.samples import SERIES_COLUMNS

_MERGED = (
    ("bytes_in", T.LongType()),
    ("bytes_out", T.LongType()),
    ("congestion_encountered", T.BooleanType()),
    ("non_ect", T.BooleanType()),
    ("hostname", T.StringType()),
)
MERGED_NAMES = [name for name, _ in _MERGED]


def place(slots: list[int], ts_ms: int) -> int:
    """Index of the first slot whose last time is older; takes that slot.

    So the times of one index increase, and no smaller index would do.
    """
    for index, last in enumerate(slots):
        if last < ts_ms:
            slots[index] = ts_ms
            return index
    slots.append(ts_ms)
    return len(slots) - 1


def _smaller(left: str | None, right: str | None) -> str | None:
    return min((name for name in (left, right) if name), default=None)


def _plain(values: Sequence) -> tuple:
    """A row's merged values as Python values."""
    bytes_in, bytes_out, congested, non_ect, name = values
    found = None if name is None or name != name else name
    return int(bytes_in), int(bytes_out), bool(congested), bool(non_ect), found


def merge(left: Sequence, right: Sequence) -> tuple:
    return (
        left[0] + right[0],
        left[1] + right[1],
        left[2] or right[2],
        left[3] or right[3],
        _smaller(left[4], right[4]),
    )


def _output(rows: DataFrame, keys: Sequence[str], more: Sequence[T.StructField]) -> T.StructType:
    fields = [T.StructField(name, rows.schema[name].dataType) for name in keys]
    return T.StructType(fields + list(more))


def _frame(schema: T.StructType, rows: list[tuple]) -> pd.DataFrame:
    kinds = {T.LongType: "Int64", T.IntegerType: "Int32", T.BooleanType: "boolean"}
    return pd.DataFrame(
        {
            field.name: pd.array(
                [row[i] for row in rows], dtype=kinds.get(type(field.dataType), "object")
            )
            for i, field in enumerate(schema.fields)
        }
    )


def _key(key: tuple) -> tuple:
    """Null parts of a key arrive as NaN for numbers."""
    return tuple(None if part is None or part != part else part for part in key)


def index_panes(rows: DataFrame, options: FlowOptions) -> DataFrame:
    """Number each series' samples so that times increase within a number.

    Rows of a batch are taken in time order, so a batch that runs again numbers
    them alike. A series' state goes when no row of it can arrive any more.
    """
    values = [T.StructField(name, kind) for name, kind in _MERGED]
    more = [T.StructField("window_start", T.LongType()), *values]
    out = _output(rows, SERIES_COLUMNS, [*more, T.StructField("pane", T.IntegerType())])
    lateness, size = options.allowed_lateness_ms, options.fixed_window_size_ms

    def number(
        key: tuple, frames: Iterable[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        slots = list(state.get[0]) if state.exists else []
        found = pd.concat(list(frames)).sort_values(["window_start", "bytes_in", "bytes_out"])
        numbered = []
        for row in found[["window_start", *MERGED_NAMES]].itertuples(index=False):
            start = int(row[0])
            pane = place(slots, start + size - 1)
            numbered.append((*_key(key), start, *_plain(row[1:]), pane))
        state.update((slots,))
        state.setTimeoutTimestamp(max(slots[0] + lateness + 1, state.getCurrentWatermarkMs() + 1))
        yield _frame(out, numbered)

    return rows.groupBy(*SERIES_COLUMNS).applyInPandasWithState(
        number, out, "slots array<bigint>", "append", GroupStateTimeout.EventTimeTimeout
    )


def accumulate_panes(rows: DataFrame, keys: Sequence[str], delay_ms: int) -> DataFrame:
    """Hold the panes of a key and window, and emit their sum after a delay.

    The delay runs from the first pane held; a later pane starts a new one.
    """
    values = [T.StructField(name, kind) for name, kind in _MERGED]
    out = _output(rows, keys, values)
    kept = T.StructType([*values, T.StructField("created", T.LongType())])

    def hold(
        key: tuple, frames: Iterable[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            held = state.get
            state.remove()
            yield _frame(out, [(*_key(key), *held[:-1])])
            return
        now = state.getCurrentProcessingTimeMs()
        held, created = (state.get[:-1], state.get[-1]) if state.exists else (None, now)
        for frame in frames:
            for row in frame[MERGED_NAMES].itertuples(index=False):
                held = _plain(row) if held is None else merge(held, _plain(row))
        state.update((*held, created))
        state.setTimeoutDuration(max(1, created + delay_ms - now))

    return rows.groupBy(*keys).applyInPandasWithState(
        hold, out, kept, "append", GroupStateTimeout.ProcessingTimeTimeout
    )


def accumulate_samples(rows: DataFrame, options: FlowOptions) -> DataFrame:
    """Hold each series' values per time, emit the old ones in time order.

    Values of one time merge while they are held. What was emitted before is
    known from the pane slots, so a value that comes too late for its time gets
    a higher pane. Everything held goes out before a series' state is dropped;
    whether that is due is looked at every ``late_processing_delay_ms``.
    """
    values = [T.StructField(name, kind) for name, kind in _MERGED]
    more = [T.StructField("window_start", T.LongType()), *values]
    out = _output(rows, SERIES_COLUMNS, [*more, T.StructField("pane", T.IntegerType())])
    entry = T.StructType([*more, T.StructField("created", T.LongType())])
    kept = T.StructType(
        [
            T.StructField("slots", T.ArrayType(T.LongType())),
            T.StructField("held", T.ArrayType(entry)),
        ]
    )
    delay, lateness = options.metric_accumulation_delay_ms, options.allowed_lateness_ms
    size, look_again = options.fixed_window_size_ms, options.late_processing_delay_ms

    def hold(
        key: tuple, frames: Iterable[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        slots, stored = ([], []) if not state.exists else state.get
        slots = list(slots)
        held = {row[0]: (tuple(row[1:-1]), row[-1]) for row in stored}
        if not state.hasTimedOut:
            for frame in frames:
                for row in frame[["window_start", *MERGED_NAMES]].itertuples(index=False):
                    start, value = int(row[0]), _plain(row[1:])
                    old, created = held.get(start, (None, now))
                    held[start] = (value if old is None else merge(old, value), created)
        newest = max([*slots[:1], *[start + size - 1 for start in held]], default=0)
        over = state.getCurrentWatermarkMs() > newest + lateness
        due = sorted(start for start, (_, made) in held.items() if over or made + delay <= now)
        flushed = []
        for start in due:
            value, _ = held.pop(start)
            flushed.append((*_key(key), start, *value, place(slots, start + size - 1)))
        if over:
            state.remove()
        else:
            state.update((slots, [(start, *v, made) for start, (v, made) in held.items()]))
            waits = [made + delay - now for _, made in held.values()]
            state.setTimeoutDuration(max(1, min([*waits, look_again])))
        if flushed:
            yield _frame(out, flushed)

    return rows.groupBy(*SERIES_COLUMNS).applyInPandasWithState(
        hold, out, kept, "append", GroupStateTimeout.ProcessingTimeTimeout
    )


def series_rows(sums: DataFrame) -> DataFrame:
    """Sums of any shapes with all key columns of a series, null where unused."""
    missing = [name for name in SERIES_COLUMNS if name not in sums.columns]
    kinds = {"protocol": "int", "dscp": "int"}
    for name in missing:
        sums = sums.withColumn(name, F.lit(None).cast(kinds.get(name, "string")))
    return sums if "hostname" in sums.columns else sums.withColumn(
        "hostname", F.lit(None).cast("string")
    )
