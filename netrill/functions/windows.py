"""Window arithmetic on epoch milliseconds.

Every exporter has its own window phase (its *shift*), so window starts are
computed columns rather than ``F.window``, whose phase is one constant.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the 32-bit golden ratio multiplier, as a signed integer.
GOLDEN_RATIO_32 = -1640531527


def whole_div(left: Column, right: Column) -> Column:
    """Integer division, truncating."""
    return F.call_function("div", left, right)


def node_shift(node_id: Column, window_ms: int) -> Column:
    """Phase of an exporter's windows, 0 <= shift < window_ms."""
    product = node_id.cast("bigint") * F.lit(GOLDEN_RATIO_32).cast("bigint")
    half, full = F.lit(1 << 31), F.lit(1 << 32)
    hashed = (F.pmod(product + half, full) - half).cast("int")
    mixed = hashed.bitwiseXOR(F.shiftrightunsigned(hashed, 16))
    return F.abs(mixed.cast("bigint")) % F.lit(window_ms).cast("bigint")


def window_number(ts: Column, shift: Column, window_ms: int) -> Column:
    return whole_div(ts - shift, F.lit(window_ms).cast("bigint"))


def window_start(ts: Column, shift: Column, window_ms: int) -> Column:
    return ts - (ts - shift) % F.lit(window_ms).cast("bigint")


def start_of_window(number: Column, shift: Column, window_ms: int) -> Column:
    return shift + number * F.lit(window_ms).cast("bigint")


def windows_reaching_back(
    delta: Column, last: Column, window_ms: int, max_duration_ms: int
) -> Column:
    """How many of a flow's first windows start too long before its end.

    Window ``i`` is emitted at ``delta + i * W`` and kept when that is later
    than ``last - max_duration``; counting the others up front keeps a flow
    with a nonsense start from being exploded at all.
    """
    surplus = last - F.lit(max_duration_ms).cast("bigint") - delta
    whole = whole_div(surplus, F.lit(window_ms).cast("bigint")) + F.lit(1).cast("bigint")
    return F.when(surplus < 0, F.lit(0).cast("bigint")).otherwise(whole)


def bytes_in_window(
    delta: Column, last: Column, scaled_bytes: Column, start: Column, end: Column
) -> Column:
    """Bytes of the flow ``[delta, last]`` that fall in ``[start, end)``.

    Difference of two truncated running totals, so that the parts of a flow
    always add up to its truncated total.
    """
    duration = last - delta + F.lit(1).cast("bigint")
    until = F.least(last + 1, end) - delta
    before = F.greatest(delta, start) - delta

    def running(covered: Column) -> Column:
        return (covered.cast("double") * scaled_bytes / duration).cast("bigint")

    return running(until) - running(before)
