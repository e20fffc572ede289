"""Flow records from, and summaries to, a Kafka topic.

The connector comes with the cluster (``spark-sql-kafka``); offsets live in the
query's checkpoint. Everything after ``value`` is the same for file sources.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession

from netrill.config import FlowOptions
from netrill.sources import protobuf


def client_properties(path: str) -> dict[str, str]:
    """``key=value`` or ``key: value`` lines; ``#`` and ``!`` start comments."""
    found = {}
    if path:
        with open(path, encoding="utf-8") as lines:
            for line in lines:
                text = line.strip()
                if not text or text[0] in "#!":
                    continue
                cut = min((text.find(c) for c in "=:" if c in text), default=len(text))
                found[text[:cut].strip()] = text[cut + 1 :].strip()
    return found


#: Spark sets these itself and refuses them as client settings.
MANAGED = (
    "group.id",
    "enable.auto.commit",
    "auto.offset.reset",
    "interceptor.classes",
    "key.deserializer",
    "value.deserializer",
    "key.serializer",
    "value.serializer",
)


def _client_options(options: FlowOptions) -> dict[str, str]:
    """Properties of the file, overridden by the configured servers."""
    known = client_properties(options.client_properties)
    for managed in MANAGED:
        if known.pop(managed, None) is not None:
            warnings.warn(f"{managed} is managed by Spark and left out", stacklevel=3)
    found = {f"kafka.{name}": value for name, value in known.items()}
    found["kafka.bootstrap.servers"] = options.bootstrap_servers
    return found


def consumer_options(options: FlowOptions) -> dict[str, str]:
    """`auto.offset.reset` of the properties file, if given, says where a new query starts."""
    reset = client_properties(options.client_properties).get("auto.offset.reset")
    return {
        **_client_options(options),
        "subscribe": options.source_topic,
        "groupIdPrefix": options.group_id,
        "startingOffsets": reset or options.starting_offsets,
        "failOnDataLoss": "true",
    }


def producer_options(options: FlowOptions) -> dict[str, str]:
    return {**_client_options(options), "topic": options.destination_topic}


def message_stream(
    spark: SparkSession, options: FlowOptions, folder: str | None = None
) -> DataFrame:
    """Messages with a binary ``value``, from the topic or from parquet files."""
    if folder is not None:
        return spark.readStream.schema("value binary").parquet(folder)
    return spark.readStream.format("kafka").options(**consumer_options(options)).load()


def flow_stream(spark: SparkSession, options: FlowOptions, folder: str | None = None) -> DataFrame:
    """Decoded flow records; malformed messages go to the quarantine stream."""
    return protobuf.accepted(protobuf.decode_flows(message_stream(spark, options, folder)))
