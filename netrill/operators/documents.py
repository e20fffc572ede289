"""Output documents: JSON text, index name, identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from netrill.config import INDEX_DATE_LENGTH, FlowOptions

DAY_MS, HOUR_MS = 86_400_000, 3_600_000


def index_name(ts_ms: Column, options: FlowOptions) -> Column:
    """``<prefix>-<date>`` of a time in UTC, whatever the session's zone is."""
    days = F.floor(ts_ms / F.lit(DAY_MS)).cast("int")
    date = F.date_add(F.lit("1970-01-01").cast("date"), days).cast("string")
    hour = F.floor(F.pmod(ts_ms, F.lit(DAY_MS)) / F.lit(HOUR_MS)).cast("string")
    text = F.concat(date, F.lit("-"), F.lpad(hour, 2, "0"))
    length = INDEX_DATE_LENGTH[options.index_strategy]
    return F.concat(F.lit(f"{options.index_prefix}-"), F.substring(text, 1, length))


def document_id(pane: Column | None = None) -> Column:
    """Same window and key, same identity: writing a document twice replaces it.

    Of a window's further panes each is a document of its own.
    """
    parts = ["range_end", "grouped_by", "node_id", "grouped_by_key"]
    further = [] if pane is None else [F.when(pane > 0, pane.cast("string"))]
    return F.md5(F.concat_ws("|", *[F.col(name).cast("string") for name in parts], *further))


def summary_json() -> Column:
    """A summary as JSON; missing fields are left out."""
    plain = [
        "range_start",
        "range_end",
        "grouped_by",
        "aggregation_type",
        "bytes_ingress",
        "bytes_egress",
        "bytes_total",
        "dscp",
        "congestion_encountered",
        "non_ect",
    ]
    keys = ["if_index", "application", "host_address", "host_name", "conversation_key"]
    exporter = F.struct("foreign_source", "foreign_id", "node_id").alias("exporter")
    return F.to_json(
        F.struct(
            F.col("range_end").alias("@timestamp"),
            *plain,
            exporter,
            *keys,
            "grouped_by_key",
            "ranking",
        )
    )


def documents(summaries: DataFrame, options: FlowOptions) -> DataFrame:
    return summaries.select(
        index_name(F.col("range_end"), options).alias("index"),
        document_id(F.col("pane") if "pane" in summaries.columns else None).alias("id"),
        F.col("range_end"),
        summary_json().alias("value"),
    )


DOCUMENT_SCHEMA = """
    `@timestamp` bigint, range_start bigint, range_end bigint, grouped_by string,
    aggregation_type string, bytes_ingress bigint, bytes_egress bigint, bytes_total bigint,
    dscp int, congestion_encountered boolean, non_ect boolean,
    exporter struct<foreign_source: string, foreign_id: string, node_id: int>,
    if_index int, application string, host_address string, host_name string,
    conversation_key string, grouped_by_key string, ranking int
"""


def parse_documents(texts: DataFrame) -> DataFrame:
    """Documents read back from their JSON, in summary columns."""
    parsed = texts.withColumn("doc", F.from_json("value", DOCUMENT_SCHEMA))
    return parsed.select(
        *[name for name in texts.columns if name != "value"], "doc.*"
    ).select("*", "exporter.*").drop("exporter", "@timestamp")
