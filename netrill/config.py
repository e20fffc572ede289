"""Parameters of a run, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass

MINUTE_MS = 60_000


@dataclass(frozen=True)
class FlowOptions:
    """All durations are milliseconds; 0 switches an optional delay off."""

    # windows and ranking
    fixed_window_size_ms: int = MINUTE_MS
    top_k: int = 10
    max_flow_duration_ms: int = 15 * MINUTE_MS
    # streaming
    default_max_input_delay_ms: int = 2 * MINUTE_MS
    early_processing_delay_ms: int = 0
    late_processing_delay_ms: int = MINUTE_MS
    allowed_lateness_ms: int = 4 * 60 * MINUTE_MS
    summary_accumulation_delay_ms: int = 0
    # Streams never take a record's time as later than now for the watermark. With a limit, flows
    # that end later than this after now are set aside as well; by default they are kept.
    max_clock_ahead_ms: int | None = None
    # metric samples
    metric_accumulation_delay_ms: int = 0
    metric_max_batch_size: int = 10_000
    metric_max_batch_bytes: int = 512 * 1024
    considered_hosts: str = ""
    # labels that every sample gets, as (name, value) pairs
    fixed_labels: tuple[tuple[str, str], ...] = ()
    # documents
    index_strategy: str = "MONTHLY"
    index_prefix: str = "flow_summaries"
    # record stream; an unset destination topic switches that sink off
    bootstrap_servers: str = "localhost:9092"
    group_id: str = "netrill"
    auto_commit: bool = True
    starting_offsets: str = "earliest"
    source_topic: str = "flows"
    destination_topic: str = ""
    client_properties: str = ""
    # output folders; an unset folder switches that sink off
    documents_path: str = ""
    samples_path: str = ""

    def __post_init__(self) -> None:
        if self.fixed_window_size_ms <= 0:
            raise ValueError("fixed_window_size_ms must be positive")
        if self.max_flow_duration_ms <= 0:
            raise ValueError("max_flow_duration_ms must be positive")
        if self.top_k <= 0:
            raise ValueError("top_k must be positive")
        if self.index_strategy not in INDEX_DATE_LENGTH:
            raise ValueError(f"unknown index strategy {self.index_strategy!r}")


# How much of an ISO "yyyy-MM-dd-HH" text names an index.
INDEX_DATE_LENGTH = {"YEARLY": 4, "MONTHLY": 7, "DAILY": 10, "HOURLY": 13}
