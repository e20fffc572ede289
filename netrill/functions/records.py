"""Normalising expressions for single flow fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from netrill.schema import UNKNOWN_APPLICATION


def is_ingress(direction: Column) -> Column:
    return F.coalesce(direction, F.lit("INGRESS")) == "INGRESS"


def delta_or_first(delta: Column, first: Column) -> Column:
    return F.coalesce(delta, first, F.lit(0).cast("bigint"))


def sampling_multiplier(sampling_interval: Column) -> Column:
    return F.when(sampling_interval > 0, sampling_interval).otherwise(F.lit(1.0))


def interface_index(direction: Column, input_index: Column, output_index: Column) -> Column:
    chosen = F.when(is_ingress(direction), input_index).otherwise(output_index)
    return F.coalesce(chosen, F.lit(0))


def both_present(value: Column, other: Column) -> Column:
    """``value`` if neither text is missing or empty, else null."""
    return F.when((F.coalesce(value, F.lit("")) != "") & (F.coalesce(other, F.lit("")) != ""), value)


def dscp_or_default(dscp: Column) -> Column:
    return F.coalesce(dscp, F.lit(0))


def application_or_unknown(application: Column) -> Column:
    return F.when(F.coalesce(application, F.lit("")) == "", F.lit(UNKNOWN_APPLICATION)).otherwise(
        application
    )


def congestion_encountered(ecn: Column) -> Column:
    return F.coalesce(ecn == 3, F.lit(False))


def non_ecn_capable(ecn: Column) -> Column:
    return ecn.isNull() | (ecn == 0)


def text(value: Column) -> Column:
    """Missing text is empty text."""
    return F.coalesce(value, F.lit(""))


def name_or_null(value: Column) -> Column:
    """Empty names count as missing, so that ``min`` ignores them."""
    return F.nullif(value, F.lit(""))


def source_is_smaller(src: Column, dst: Column) -> Column:
    """True if the source is the first endpoint; equal texts put dst first."""
    return text(src) < text(dst)
