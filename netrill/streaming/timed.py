"""Panes with their real delays, and values held between panes and sinks.

`timed_panes` keeps one small state row per key and window. A pane is

``early``    rows before the watermark passes the window's end, fired a delay after the
             pane's first row; only if `early_processing_delay_ms` is set
``on_time``  what is open when the watermark passes the end
``late``     later rows, fired `late_processing_delay_ms` after the pane's first row
``too_late`` rows whose window is over for good; not merged, not part of any sum

What is open when a window ends for good is fired before the state goes, so a stopped
and drained stream loses nothing. Panes are numbered per key and window.

Delays are counted on a clock: the time of the trigger, or a column of the rows with their
time of arrival (a topic's timestamps), which makes a replay repeatable. State is woken by
event time. A delay's timer is set that far ahead of the watermark, which on a live stream
moves with the clock; if it has not moved far enough when it fires it is set again. When
all input stops, so does the watermark: what is open then waits for the next record, or
for the closing record of a drained input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from netrill.config import FlowOptions
from netrill.operators import reducers
from netrill.operators.reducers import Reducer
from netrill.operators.samples import SERIES_COLUMNS
from netrill.operators.windowing import window_rows
from netrill.plans.sums import KEY_COLUMNS
from netrill.streaming import sinks
from netrill.streaming.series import _frame, _key, place
from netrill.streaming.windows import (
    CLOSING,
    STATE_SETTINGS,
    BatchWriter,
    Policy,
    start,
    unless_closing,
    without_closing,
)

EARLY, ON_TIME, LATE, TOO_LATE = "early", "on_time", "late", "too_late"
LEAF = ["window_end", *KEY_COLUMNS]
#: The rows' own time of arrival, if the clock is to be theirs.
ARRIVED = "arrived_ms"
SEEN_AT = "seen_at"

def last_switched_or_now(flows: DataFrame, options: FlowOptions) -> Column:
    """Event time of a record for the watermark: its end, but never ahead of the clock."""
    return unless_closing(flows, F.col("last_switched"), F.unix_millis(F.current_timestamp()))


def slack_ms(options: FlowOptions) -> int:
    """How far Spark's watermark is behind the one that panes go by.

    Spark drops rows behind its own, so that must not pass a record of a window that is
    still open: such a record ends at most one window before the window does.
    """
    return options.allowed_lateness_ms + options.fixed_window_size_ms


def timed_rows(flows: DataFrame, options: FlowOptions, policy: Policy = last_switched_or_now) -> DataFrame:
    """Window rows of a stream with a watermark by `policy`; ahead of the clock, data is kept."""
    keep = [name for name in (ARRIVED, CLOSING) if name in flows.columns]
    marked = flows.withColumn(SEEN_AT, F.timestamp_millis(policy(flows, options)))
    delay = options.default_max_input_delay_ms + slack_ms(options)
    marked = marked.withWatermark(SEEN_AT, f"{delay} milliseconds")
    return without_closing(window_rows(marked, options, keep=[*keep, SEEN_AT]), SEEN_AT)


def _parts(frame: pd.DataFrame) -> list[pd.DataFrame]:
    """The rows by their time of arrival, if they bring it."""
    return [part for _, part in frame.groupby(ARRIVED, sort=True)] if ARRIVED in frame else [frame]


class _Timed(StatefulProcessor):
    """Common to operators that hold values for a delay and until their window is over."""

    def __init__(self, out: T.StructType, reducer: Reducer, options: FlowOptions) -> None:
        self.out, self.reducer, self.slack = out, reducer, slack_ms(options)
        self.lateness, self.size = options.allowed_lateness_ms, options.fixed_window_size_ms

    def clock(self, timer_values, frame: pd.DataFrame | None = None) -> int:
        if frame is not None and ARRIVED in frame:
            return int(frame[ARRIVED].max())
        return timer_values.getCurrentProcessingTimeInMs()

    def watermark(self, timer_values) -> int:
        """Up to where records are expected to be complete."""
        return timer_values.getCurrentWatermarkInMs() + self.slack

    def wake(self, handle: StatefulProcessorHandle, timer_values, watermark: int) -> None:
        """A timer for when the watermark of panes comes to a time, at least a millisecond on."""
        soonest = timer_values.getCurrentWatermarkInMs() + 1
        handle.registerTimer(max(soonest, watermark - self.slack))

    def close(self) -> None:
        pass


class Hold:
    """Panes merged for a delay, in a state of their own: values, rows, begin, last timing."""

    def __init__(self, handle: StatefulProcessorHandle, reducer: Reducer, delay: int) -> None:
        self.reducer, self.delay = reducer, delay
        more = [T.StructField(name, T.LongType()) for name in ("n", "began")]
        kept = T.StructType([*reducer.schema, *more, T.StructField("timing", T.StringType())])
        self.state = handle.getValueState("held", kept)

    def add(self, values: tuple, n: int, timing: str, now: int) -> tuple[tuple, int, str] | None:
        """Hold a pane more; what was held before and is due comes out."""
        out, found = self.flush(now), self.state.get()
        if found is None:
            self.state.update((*values, n, now, timing))
        else:
            *held, rows, began, _ = found
            self.state.update((*self.reducer.merge(held, values), rows + n, began, timing))
        return out

    def left(self, now: int) -> int | None:
        """Milliseconds until what is held is due."""
        found = self.state.get()
        return None if found is None else found[-2] + self.delay - now

    def flush(self, now: int | None) -> tuple[tuple, int, str] | None:
        """What is held if it is due, or whatever is held if no time is given."""
        found = self.state.get()
        if found is None or now is not None and now < found[-2] + self.delay:
            return None
        self.state.clear()
        return tuple(found[:-3]), found[-3], found[-1]


class PaneProcessor(_Timed):
    """State: values and row count of the open pane, when it began, panes put out so far.

    With `summary_accumulation_delay_ms` fired panes are held and merged for that long; they come
    out with the timing of the last one.
    """

    def __init__(self, out: T.StructType, reducer: Reducer, options: FlowOptions, by_arrival: bool) -> None:
        super().__init__(out, reducer, options)
        self.delays = {EARLY: options.early_processing_delay_ms, LATE: options.late_processing_delay_ms}
        self.by_arrival, self.held_for = by_arrival, options.summary_accumulation_delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        more = [T.StructField(name, T.LongType()) for name in ("n", "began", "late", "fired")]
        self.state = handle.getValueState("pane", T.StructType([*self.reducer.schema, *more]))
        self.hold = Hold(handle, self.reducer, self.held_for) if self.held_for else None

    def read(self) -> tuple[tuple | None, int, int, bool, int]:
        """Values (None: no open pane), rows, begin, whether begun as late, panes fired."""
        found = self.state.get()
        if found is None:
            return None, 0, 0, False, 0
        *values, n, began, late, fired = found
        return (tuple(values) if n else None), n or 0, began or 0, bool(late), fired

    def write(self, values: tuple | None, n: int, began: int, late: bool, fired: int) -> None:
        empty = (None,) * len(self.reducer.fields)
        self.state.update((*(values or empty), n if values else 0, began, int(late), fired))

    def row(self, key: tuple, values: tuple, timing: str, fired: int, n: int) -> tuple:
        return (*_key(key), *values, timing, fired, n)

    def fire(self, out: list, key: tuple, pane: tuple[tuple, int], timing: str, fired: int, now: int) -> int:
        """Put a pane out, or hold it and put out what is due; the number of panes put out by now."""
        ready = self.hold.add(*pane, timing, now) if self.hold else (*pane, timing)
        if ready is not None:
            out.append(self.row(key, ready[0], ready[2], fired, ready[1]))
            fired += 1
        return fired

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        end, passed = int(key[0]), self.watermark(timerValues)
        values, n, began, late, fired = self.read()
        out: list[tuple] = []
        for frame in rows:
            for part in _parts(frame):
                now, new = self.clock(timerValues, part), self.reducer.of_frame(part)
                if end + self.lateness <= passed:
                    out.append(self.row(key, new, TOO_LATE, -1, len(part)))
                    continue
                if values is not None and (timing := self.due(end, passed, began, late, now)):
                    fired = self.fire(out, key, (values, n), timing, fired, now)
                    values = None
                if values is None:
                    values, n, began, late = new, len(part), now, end <= passed
                else:
                    values, n = self.reducer.merge(values, new), n + len(part)
        if end + self.lateness > passed:
            self.write(values, n, began, late, fired)
            self.set_timers(end, passed, values is not None, late, timerValues)
        if out:
            yield _frame(self.out, out)

    def due(self, end: int, passed: int, began: int, late: bool, now: int) -> str | None:
        """What the open pane is fired as at this moment, if it is."""
        if not late and end <= passed:
            return ON_TIME
        timing = LATE if late else EARLY
        delay = self.delays[timing]
        # Without a delay there are no early panes; late ones fire with the next trigger.
        return timing if (late or delay) and now >= began + delay else None

    def set_timers(self, end: int, passed: int, is_open: bool, late: bool, timer_values) -> None:
        self.wake(self.handle, timer_values, end + self.lateness)
        if end > passed:
            self.wake(self.handle, timer_values, end)
        if self.by_arrival:
            return
        delay = self.delays[LATE if late else EARLY]
        if is_open and (late or delay):
            self.wake(self.handle, timer_values, passed + delay)
        left = self.hold.left(self.clock(timer_values)) if self.hold else None
        if left is not None:
            self.wake(self.handle, timer_values, passed + left)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.get() is None:
            return
        end, passed = int(key[0]), self.watermark(timerValues)
        values, n, began, late, fired = self.read()
        over, out = end + self.lateness <= passed, []
        # Rows that bring their own time say what is due only when they come.
        now = began if self.by_arrival else self.clock(timerValues)
        timing = self.due(end, passed, began, late, now) if values is not None else None
        if over and values is not None and timing is None:
            timing = LATE
        if timing:
            fired = self.fire(out, key, (values, n), timing, fired, now)
            values = None
        rest = self.hold.flush(None if over else now) if self.hold and (over or not self.by_arrival) else None
        if rest is not None:
            out.append(self.row(key, rest[0], rest[2], fired, rest[1]))
            fired += 1
        if over:
            self.state.clear()
        else:
            self.write(values, n, began, late, fired)
            self.set_timers(end, passed, values is not None, late, timerValues)
        if out:
            yield _frame(self.out, out)


def _fields(rows: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(name, rows.schema[name].dataType) for name in names]


def timed_panes(
    rows: DataFrame, options: FlowOptions, keys: Sequence[str] = LEAF, reducer: Reducer = reducers.LEAF
) -> DataFrame:
    """Panes of `timed_rows`: keys, merged values, timing, pane and the number of rows in it.

    The first of `keys` is the window's end. With a column `arrived_ms` delays go by it.
    """
    more = [T.StructField("timing", T.StringType()), T.StructField("pane", T.LongType()), T.StructField("rows", T.LongType())]
    out = T.StructType([*_fields(rows, keys), *reducer.schema, *more])
    processor = PaneProcessor(out, reducer, options, ARRIVED in rows.columns)
    return rows.groupBy(*keys).transformWithStateInPandas(processor, out, "append", "EventTime")


class HoldProcessor(_Timed):
    """Merges what comes of a key and window for a delay, and until the window is over."""

    def __init__(self, out: T.StructType, reducer: Reducer, options: FlowOptions, delay: int) -> None:
        super().__init__(out, reducer, options)
        self.delay = delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.hold = Hold(handle, self.reducer, self.delay)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed, out = self.watermark(timerValues), []
        for frame in rows:
            for part in _parts(frame):
                now = self.clock(timerValues, part)
                ready = self.hold.add(self.reducer.of_frame(part), len(part), "", now)
                if ready is not None:
                    out.append((*_key(key), *ready[0]))
        self.wake(self.handle, timerValues, passed + self.delay)
        self.wake(self.handle, timerValues, int(key[0]) + self.lateness)
        if out:
            yield _frame(self.out, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed, now = self.watermark(timerValues), self.clock(timerValues)
        over = int(key[0]) + self.lateness <= passed
        ready = self.hold.flush(None if over else now)
        if ready is not None:
            yield _frame(self.out, [(*_key(key), *ready[0])])
        elif (left := self.hold.left(now)) is not None:
            self.wake(self.handle, timerValues, passed + left)


def held_panes(
    rows: DataFrame, options: FlowOptions, delay_ms: int, keys: Sequence[str] = LEAF, reducer: Reducer = reducers.LEAF
) -> DataFrame:
    """Panes of a key and window merged for a delay, counted from the first one held.

    A pane after that starts a new one. What is held when the window is over for good goes out.
    `rows` have a watermark as of `timed_rows`; the first of `keys` is the window's end.
    """
    out = T.StructType([*_fields(rows, keys), *reducer.schema])
    processor = HoldProcessor(out, reducer, options, delay_ms)
    return rows.groupBy(*keys).transformWithStateInPandas(processor, out, "append", "EventTime")


class SampleProcessor(_Timed):
    """State of a series: values held by event time, and the newest time of each pane index.

    Held values are a map in the state store, so one value more writes one entry.
    """

    def __init__(self, out: T.StructType, reducer: Reducer, options: FlowOptions) -> None:
        super().__init__(out, reducer, options)
        self.delay = options.metric_accumulation_delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        start = T.StructType([T.StructField("window_start", T.LongType())])
        kept = T.StructType([*self.reducer.schema, T.StructField("began", T.LongType())])
        self.held = handle.getMapState("held", start, kept)
        slots = T.StructType([T.StructField("slots", T.ArrayType(T.LongType()))])
        self.slots = handle.getValueState("slots", slots)

    def flush(self, key: tuple, slots: list[int], wanted: Callable[[int], bool]) -> Iterator[pd.DataFrame]:
        """Emit the held values whose begin is `wanted`, in time order, with their pane index."""
        due = sorted((start[0], kept) for start, kept in self.held.iterator() if wanted(kept[-1]))
        out = []
        for start, kept in due:
            self.held.removeKey((start,))
            out.append((*_key(key), start, *kept[:-1], place(slots, start + self.size - 1)))
        if out:
            yield _frame(self.out, out)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = self.slots.get()
        slots, newest = (list(found[0]), 0) if found else ([], 0)
        for frame in rows:
            for part in _parts(frame):
                now = self.clock(timerValues, part)
                yield from self.flush(key, slots, lambda began, now=now: began + self.delay <= now)
                for start, group in part.groupby("window_start", sort=True):
                    start, new = int(start), self.reducer.of_frame(group)
                    old = self.held.getValue((start,)) if self.held.containsKey((start,)) else None
                    kept = (*new, now) if old is None else (*self.reducer.merge(old[:-1], new), old[-1])
                    self.held.updateValue((start,), kept)
                    newest = max(newest, start + self.size)
        self.slots.update((slots,))
        self.wake(self.handle, timerValues, self.watermark(timerValues) + self.delay)
        # The series ends once nothing of its newest time can come any more.
        self.wake(self.handle, timerValues, newest + self.lateness)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        found = self.slots.get()
        if found is None:
            return
        passed, slots = self.watermark(timerValues), list(found[0])
        times = [start[0] + self.size for start in self.held.keys()]
        newest = max([*times, *[slot + 1 for slot in slots]], default=0)
        if newest + self.lateness <= passed:
            yield from self.flush(key, slots, lambda began: True)
            self.held.clear()
            self.slots.clear()
            return
        now = self.clock(timerValues)
        yield from self.flush(key, slots, lambda began: began + self.delay <= now)
        self.slots.update((slots,))
        waits = [kept[-1] + self.delay - now for kept in self.held.values()]
        if waits:
            self.wake(self.handle, timerValues, passed + min(waits))


def held_samples(rows: DataFrame, options: FlowOptions, reducer: Reducer = reducers.SERIES) -> DataFrame:
    """A series' values by time, held for `metric_accumulation_delay_ms`, with their pane index.

    Values of one time merge while they are held. All that is held goes out when the series
    ends: `allowed_lateness_ms` after its newest window. `rows` have series keys, window_start
    and a watermark as of `timed_rows`.
    """
    more = [T.StructField("window_start", T.LongType()), *reducer.schema, T.StructField("pane", T.IntegerType())]
    out = T.StructType([*_fields(rows, SERIES_COLUMNS), *more])
    processor = SampleProcessor(out, reducer, options)
    return rows.groupBy(*SERIES_COLUMNS).transformWithStateInPandas(processor, out, "append", "EventTime")


def start_timed(
    found: DataFrame, write: BatchWriter, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Start a query of these operators; their state needs the recommended state store."""
    conf = found.sparkSession.conf
    before = {name: conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        conf.set(name, value)
    try:
        return start(found, "append", write, checkpoint, once)
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)


def start_sinks(
    flows: DataFrame,
    options: FlowOptions,
    checkpoint: str,
    folder: str,
    records_path: str | None = None,
    once: bool = True,
    policy: Policy = last_switched_or_now,
) -> StreamingQuery:
    """Panes of flows, by the delays in `options`, to all sinks whose target is set.

    Rows that are too late for their window go below `folder`, with the batch's other outputs.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            late = batch.filter(F.col("timing") == TOO_LATE)
            late.write.mode("overwrite").parquet(f"{folder}/too_late/batch={batch_id}")
            panes = batch.filter(F.col("timing") != TOO_LATE).drop("timing", "pane", "rows")
            sinks.commit(panes, options, batch_id, folder, records_path)
        finally:
            batch.unpersist()

    found = timed_panes(timed_rows(flows, options, policy), options)
    return start_timed(found, write, checkpoint, once)
