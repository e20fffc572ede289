"""Queries over output forms: documents, records, metric samples, their sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from netrill.catalog.oracle import CONV, ITF, SHAPES
from netrill.catalog.registry import register
from netrill.config import FlowOptions
from netrill.functions import metrics
from netrill.operators import documents, observe, reports, samples, windowing
from netrill.operators.topk import complete_conversation
from netrill.plans import groupings as G
from netrill.plans.sums import shape_sums
from netrill.plans.summaries import build_summaries, rank_shapes, to_summaries
from netrill.schema import SUMMARY_COLUMNS
from netrill.session import shared_folder
from netrill.sinks import writers
from netrill.sources import tables

OPTIONS = FlowOptions()
W = OPTIONS.fixed_window_size_ms
HOSTS = FlowOptions(considered_hosts="0.0.0.0-0.0.0.255,10.0.0.0/28,10.0.0.30")


def _ranked(spark: SparkSession, sf_dir: str, *shapes: str) -> DataFrame:
    rows = windowing.window_rows(tables.flows(spark, sf_dir), OPTIONS)
    found = shape_sums(rows, shapes or G.EMITTED, complete_conversation())
    return rank_shapes(found, OPTIONS.top_k)


def _samples(spark: SparkSession, sf_dir: str, options: FlowOptions = OPTIONS) -> DataFrame:
    ranked = _ranked(spark, sf_dir, *samples.shapes(options))
    kept = samples.included(ranked, options).withColumn("pane", F.lit(0))
    return samples.to_samples(kept, W)


def _flat(found: DataFrame) -> DataFrame:
    return found.select(
        samples.label_text(F.col("labels")).alias("series"), "ts_ms", "value"
    )


# Label names in order, and the expressions of their values, per shape.
_LABELS = {
    "nodeId": "cast(node_id as varchar)",
    "ifIndex": "cast(if_index as varchar)",
    "dscp": "cast(dscp as varchar)",
    "application": "application",
    "host": "address",
    "host2": "larger_address",
    "location": "location",
    "protocol": "coalesce(cast(protocol as varchar), 'null')",
}
_METRIC_PREFIX = {
    "EXPORTER_INTERFACE_APPLICATION": "BY_APP_",
    "EXPORTER_INTERFACE_TOS_APPLICATION": "BY_TOS_AND_APP_",
    "EXPORTER_INTERFACE_HOST": "BY_HOST_",
    "EXPORTER_INTERFACE_TOS_HOST": "BY_TOS_AND_HOST_",
    "EXPORTER_INTERFACE_CONVERSATION": "BY_CONV_",
    "EXPORTER_INTERFACE_TOS_CONVERSATION": "BY_TOS_AND_CONV_",
}


def _metric_sql(name: str) -> str:
    if name not in _METRIC_PREFIX:
        return f"'{name}'"
    return f"'{_METRIC_PREFIX[name]}' || node_id || '_' || if_index"


def _label_names(name: str) -> list[str]:
    if "CONVERSATION" in name:
        found = ["location", "protocol", "host", "host2", "application"]
    elif "HOST" in name:
        found = ["host"]
    elif "APPLICATION" in name:
        found = ["application"]
    else:
        found = ["nodeId", "ifIndex"]
    return found + (["dscp"] if "TOS" in name else [])


def _series_sql(name: str, direction: str, fixed: tuple[str, ...] = ()) -> str:
    values = {"__name__": _metric_sql(name), "pane": "'0'", "direction": f"'{direction}'"}
    values.update({label: _LABELS[label] for label in _label_names(name)})
    values.update({pair.split("=")[0]: f"'{pair.split('=')[1]}'" for pair in fixed})
    return " || ',' || ".join(f"'{label}=' || {values[label]}" for label in sorted(values))


def _samples_sql(names, where=None, fixed=()) -> str:
    parts = []
    for name in names:
        table = ("top_" if name in _METRIC_PREFIX else "sum_") + name.lower()
        for direction in ("in", "out"):
            parts.append(
                f"select {_series_sql(name, direction, fixed)} as series,"
                f" window_start + {W - 1} as ts_ms, cast(bytes_{direction} as double) as value"
                f" from {table}" + ((where or {}).get(name, ""))
            )
    return " union all ".join(parts)


NO_HOSTS = [n for n in SHAPES if "HOST" not in n and "CONVERSATION" not in n]
WITH_HOSTS = [n for n in SHAPES if "CONVERSATION" not in n]
_IN_RANGE = (
    " where address <> '' and (cast(split_part(address, '.', 4) as integer) between 0 and 15"
    " or cast(split_part(address, '.', 4) as integer) = 30)"
)
HOSTS_IN_RANGE = {n: _IN_RANGE for n in SHAPES if "HOST" in n}


@register("to_flow_summary", f"select {', '.join(SUMMARY_COLUMNS)} from out_exporter_interface_tos_host")
def to_flow_summary(spark, sf_dir):
    return to_summaries(_ranked(spark, sf_dir, G.TOS_HOST), W)


@register(
    "project_app",
    f"select window_start, {ITF}, dscp, application, cast(null as varchar) as hostname,"
    " bytes_in, bytes_out from leaf",
)
def project_app(spark, sf_dir):
    from netrill.plans.sums import leaf_sums

    leaf = leaf_sums(windowing.window_rows(tables.flows(spark, sf_dir), OPTIONS))
    return leaf.select(
        "window_start", "node_id", "foreign_source", "foreign_id", "if_index", "dscp",
        "application", F.lit(None).cast("string").alias("hostname"), "bytes_in", "bytes_out",
    )


@register(
    "project_hosts",
    f"select window_start, {ITF}, dscp, address, hostname, bytes_in, bytes_out from hosts",
)
def project_hosts(spark, sf_dir):
    from netrill.operators.aggregate import with_endpoints
    from netrill.plans.sums import leaf_sums

    leaf = leaf_sums(windowing.window_rows(tables.flows(spark, sf_dir), OPTIONS))
    return with_endpoints(leaf).select(
        "window_start", "node_id", "foreign_source", "foreign_id", "if_index", "dscp",
        "address", "hostname", "bytes_in", "bytes_out",
    )


@register(
    "drop_tos",
    f"select window_start, {ITF}, {CONV}, bytes_in, bytes_out from leaf",
)
def drop_tos(spark, sf_dir):
    """The cast of each leaf row to the key without DSCP, before any sum."""
    from netrill.plans.sums import leaf_sums

    leaf = leaf_sums(windowing.window_rows(tables.flows(spark, sf_dir), OPTIONS))
    return leaf.select(
        "window_start", *G.GROUPINGS[G.CONVERSATION].columns, "bytes_in", "bytes_out"
    )


@register(
    "outer_key",
    f"select {ITF}, dscp, application, node_id || '/' || if_index || '/' || dscp as parent,"
    " count(*) as windows from sum_exporter_interface_tos_application group by all",
)
def outer_key(spark, sf_dir):
    shape = G.GROUPINGS[G.TOS_APPLICATION]
    rows = windowing.window_rows(tables.flows(spark, sf_dir), OPTIONS)
    found = shape_sums(rows, [shape.name])
    parent = [name for name in shape.parent_columns if not name.startswith("foreign")]
    return found.groupBy(
        *shape.columns, F.concat_ws("/", *parent).alias("parent")
    ).agg(F.count("*").alias("windows"))


@register(
    "index_name",
    " union all ".join(
        f"select '{strategy}' as strategy, 'flow_summaries-' || strftime(make_timestamp("
        f"range_end * 1000), '{pattern}') as index, count(*) as documents from summaries group by all"
        for strategy, pattern in (
            ("YEARLY", "%Y"),
            ("MONTHLY", "%Y-%m"),
            ("DAILY", "%Y-%m-%d"),
            ("HOURLY", "%Y-%m-%d-%H"),
        )
    ),
)
def index_name(spark, sf_dir):
    summaries = build_summaries(tables.flows(spark, sf_dir), OPTIONS)
    names = F.array(
        *[
            F.struct(
                F.lit(strategy).alias("strategy"),
                documents.index_name(
                    F.col("range_end"), FlowOptions(index_strategy=strategy)
                ).alias("index"),
            )
            for strategy in ("YEARLY", "MONTHLY", "DAILY", "HOURLY")
        ]
    )
    return (
        summaries.select(F.inline(names)).groupBy("strategy", "index")
        .agg(F.count("*").alias("documents"))
    )


_JSON_FIELDS = (
    ("@timestamp", "range_end", False),
    ("range_start", "range_start", False),
    ("range_end", "range_end", False),
    ("grouped_by", "grouped_by", True),
    ("aggregation_type", "aggregation_type", True),
    ("bytes_ingress", "bytes_ingress", False),
    ("bytes_egress", "bytes_egress", False),
    ("bytes_total", "bytes_total", False),
    ("dscp", "dscp", False),
    ("congestion_encountered", "congestion_encountered", False),
    ("non_ect", "non_ect", False),
    ("exporter", None, False),
    ("if_index", "if_index", False),
    ("application", "application", True),
    ("host_address", "host_address", True),
    ("host_name", "host_name", True),
    ("conversation_key", "conversation_key", True),
    ("grouped_by_key", "grouped_by_key", True),
    ("ranking", "ranking", False),
)
_EXPORTER_JSON = (
    "'\"exporter\":{' || coalesce('\"foreign_source\":\"' || foreign_source || '\",', '')"
    " || coalesce('\"foreign_id\":\"' || foreign_id || '\",', '') || '\"node_id\":'"
    " || node_id || '}'"
)


def _json_sql() -> str:
    parts = []
    for name, column, is_text in _JSON_FIELDS:
        if column is None:
            parts.append(_EXPORTER_JSON)
        elif is_text:
            parts.append(f"'\"{name}\":' || cast(to_json({column}) as varchar)")
        else:
            parts.append(f"'\"{name}\":' || cast({column} as varchar)")
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


@register("summary_json", f"select {_json_sql()} as value from summaries")
def summary_json(spark, sf_dir):
    summaries = build_summaries(tables.flows(spark, sf_dir), OPTIONS)
    return summaries.select(documents.summary_json().alias("value"))


_DOCUMENT_SQL = (
    "select md5(concat_ws('|', range_end, grouped_by, node_id, grouped_by_key)) as id,"
    " 'flow_summaries-' || strftime(make_timestamp(range_end * 1000), '%Y-%m') as index,"
    f" {', '.join(SUMMARY_COLUMNS)} from summaries"
)


@register("sink_search_docs", _DOCUMENT_SQL)
def sink_search_docs(spark, sf_dir):
    """Written twice, as after a failure: the second run replaces the first."""
    path = shared_folder(spark, "documents")
    made = shared_folder(spark, "summaries")
    build_summaries(tables.flows(spark, sf_dir), OPTIONS).write.parquet(made)
    summaries = spark.read.parquet(made)
    for _ in range(2):
        writers.write_documents(summaries, path, OPTIONS)
    return writers.read_documents(spark, path)


@register("sink_kafka_json", f"select {_json_sql()} as value from summaries")
def sink_kafka_json(spark, sf_dir):
    path = shared_folder(spark, "records")
    writers.write_records(build_summaries(tables.flows(spark, sf_dir), OPTIONS), OPTIONS, path)
    return spark.read.text(path).select("value")


def _written_samples(spark: SparkSession, sf_dir: str, options: FlowOptions) -> DataFrame:
    path = shared_folder(spark, "samples")
    ranked = _ranked(spark, sf_dir, *samples.shapes(options))
    kept = samples.included(ranked, options).withColumn("pane", F.lit(0))
    writers.write_samples(kept, path, options)
    return spark.read.parquet(path)


@register("sink_metric_samples", _samples_sql(NO_HOSTS))
def sink_metric_samples(spark, sf_dir):
    return _written_samples(spark, sf_dir, OPTIONS).select("series", "ts_ms", "value")


@register(
    "sink_series_order",
    f"select 0 as violations, count(*) as samples from ({_samples_sql(NO_HOSTS)})",
)
def sink_series_order(spark, sf_dir):
    """Written samples that are not later than the one before them."""
    written = _written_samples(spark, sf_dir, OPTIONS)
    wrong = reports.series_violations(written, ["series"]).select(F.lit(1).alias("bad"))
    return wrong.unionByName(written.select(F.lit(0).alias("bad"))).agg(
        F.count_if(F.col("bad") == 1).alias("violations"),
        F.count_if(F.col("bad") == 0).alias("samples"),
    )


SMALL_BATCHES = FlowOptions(metric_max_batch_size=100, metric_max_batch_bytes=8_000)


@register(
    "sample_batches",
    f"select count(*) as samples, true as within_count, true as within_bytes, true as cut_late"
    f" from ({_samples_sql(NO_HOSTS)})",
)
def sample_batches(spark, sf_dir):
    """Every batch keeps both limits, and none closed while the next sample fit."""
    cut = writers.cut_batches(writers.with_series(_samples(spark, sf_dir)), SMALL_BATCHES)
    most, largest = SMALL_BATCHES.metric_max_batch_size, SMALL_BATCHES.metric_max_batch_bytes
    found = cut.groupBy("writer", "batch").agg(
        F.count("*").alias("n"),
        F.sum("size").alias("bytes"),
        F.min_by("size", "written").alias("first_size"),
    )
    following = found.select(
        "writer", (F.col("batch") - 1).alias("batch"), F.col("first_size").alias("next_size")
    )
    full = (F.col("n") == most) | (F.col("bytes") + F.col("next_size") > largest)
    return found.join(following, ["writer", "batch"], "left").agg(
        F.sum("n").alias("samples"),
        (F.max("n") <= most).alias("within_count"),
        (F.max("bytes") <= largest).alias("within_bytes"),
        F.bool_and(F.coalesce(full, F.lit(True))).alias("cut_late"),
    )


@register("fixed_labels", _samples_sql([G.INTERFACE, G.TOS], fixed=("run=r1",)))
def fixed_labels(spark, sf_dir):
    kept = _ranked(spark, sf_dir, G.INTERFACE, G.TOS).withColumn("pane", F.lit(0))
    return _flat(samples.to_samples(kept, W, {"run": "r1"}))


@register(
    "sink_fan_out",
    "select 'documents' as sink, count(*) as written from summaries union all"
    " select 'records', count(*) from summaries union all"
    f" select 'samples', count(*) from ({_samples_sql(NO_HOSTS)})",
)
def sink_fan_out(spark, sf_dir):
    """All sinks whose target is set, from one evaluation of the summaries."""
    from netrill.streaming.sinks import fan_out

    base = shared_folder(spark, "fan-out")
    options = FlowOptions(documents_path=f"{base}/documents", samples_path=f"{base}/samples")
    rows = windowing.window_rows(tables.flows(spark, sf_dir), options)
    fan_out(rows, options, records_path=f"{base}/records")
    sizes = [
        spark.read.text(f"{base}/documents").select(F.lit("documents").alias("sink")),
        spark.read.text(f"{base}/records").select(F.lit("records").alias("sink")),
        spark.read.parquet(f"{base}/samples").select(F.lit("samples").alias("sink")),
    ]
    every = sizes[0].unionByName(sizes[1]).unionByName(sizes[2])
    return every.groupBy("sink").agg(F.count("*").alias("written"))


@register(
    "metric_name",
    " union all ".join(
        f"select distinct '{name}' as grouped_by, node_id, if_index, {_metric_sql(name)} as name"
        f" from {('top_' if name in _METRIC_PREFIX else 'sum_') + name.lower()}"
        for name in SHAPES
    ),
)
def metric_name(spark, sf_dir):
    return _ranked(spark, sf_dir).select(
        "grouped_by", "node_id", "if_index", samples.metric_name().alias("name")
    ).distinct()


@register("metric_labels", _samples_sql(SHAPES))
def metric_labels(spark, sf_dir):
    every = _ranked(spark, sf_dir).withColumn("pane", F.lit(0))
    return _flat(samples.to_samples(every, W))


@register(
    "in_out_series",
    "select node_id, if_index, 'in' as direction, window_start + 59999 as ts_ms,"
    " cast(bytes_in as double) as value from sum_exporter_interface union all"
    " select node_id, if_index, 'out', window_start + 59999, cast(bytes_out as double)"
    " from sum_exporter_interface",
)
def in_out_series(spark, sf_dir):
    kept = _ranked(spark, sf_dir, G.INTERFACE).withColumn("pane", F.lit(0))
    return samples.to_samples(kept, W).select("node_id", "if_index", "direction", "ts_ms", "value")


@register(
    "sample_timestamp",
    f"select window_start, window_start + {W - 1} as ts_ms, cast(bytes_in as double) as value"
    " from sum_exporter_interface",
)
def sample_timestamp(spark, sf_dir):
    kept = _ranked(spark, sf_dir, G.INTERFACE).withColumn("pane", F.lit(0))
    found = samples.to_samples(kept, W).filter("direction = 'in'")
    return found.select((F.col("ts_ms") - (W - 1)).alias("window_start"), "ts_ms", "value")


@register(
    "sanitize_metric_name",
    "select application, src_address, regexp_replace(regexp_replace(name, '[^A-Za-z0-9_:]', '_',"
    " 'g'), '^[0-9]', '_') as name from (select distinct application, src_address,"
    " src_address || '-' || application || ':x' as name from flows)",
)
def sanitize_metric_name(spark, sf_dir):
    raw = F.concat("src_address", F.lit("-"), "application", F.lit(":x"))
    distinct = tables.flows(spark, sf_dir).select("application", "src_address").distinct()
    return distinct.withColumn("name", metrics.sanitize_metric_name(raw))


@register(
    "sanitize_label_name",
    "select application, src_address, regexp_replace(regexp_replace(name, '[^A-Za-z0-9_]', '_',"
    " 'g'), '^[0-9]', '_') as name from (select distinct application, src_address,"
    " src_address || '-' || application || ':x' as name from flows)",
)
def sanitize_label_name(spark, sf_dir):
    raw = F.concat("src_address", F.lit("-"), "application", F.lit(":x"))
    distinct = tables.flows(spark, sf_dir).select("application", "src_address").distinct()
    return distinct.withColumn("name", metrics.sanitize_label_name(raw))


@register("metrics_include", _samples_sql(WITH_HOSTS, HOSTS_IN_RANGE))
def metrics_include(spark, sf_dir):
    return _flat(_samples(spark, sf_dir, HOSTS))


@register(
    "pane_index",
    f"""select window_start, {ITF}, dscp, part, bytes_in,
      row_number() over (partition by window_start, {ITF}, dscp order by part) - 1 as pane
      from (select window_start, {ITF}, dscp, ls % 3 as part,
        cast(sum(bytes_in) as bigint) as bytes_in from win group by all)""",
)
def pane_index(spark, sf_dir):
    """Up to three panes per DSCP total and window get increasing indexes."""
    rows = windowing.window_rows(
        tables.flows(spark, sf_dir), OPTIONS, keep=("last_switched",)
    ).withColumn("part", F.col("last_switched") % 3)
    base = ["window_start", *G.GROUPINGS[G.TOS].columns, "part"]
    panes = rows.groupBy(*base).agg(F.sum("bytes_in").alias("bytes_in"))
    missing = [name for name in samples.SERIES_COLUMNS if name not in panes.columns]
    shaped = panes.select(
        "*", *[F.lit(None).cast("string").alias(name) for name in missing]
    )
    return samples.with_pane(shaped, F.col("part")).select(*base, "bytes_in", "pane")


@register(
    "end_of_window_timestamp",
    f"select window_start, {ITF}, window_start + {W - 1} as event_ts, bytes_in + bytes_out as"
    " bytes_total from sum_exporter_interface",
)
def end_of_window_timestamp(spark, sf_dir):
    """Windows with rows only, each stamped with its last millisecond."""
    found = _ranked(spark, sf_dir, G.INTERFACE)
    return found.select(
        "window_start", "node_id", "foreign_source", "foreign_id", "if_index",
        (F.col("window_start") + (W - 1)).alias("event_ts"),
        (F.col("bytes_in") + F.col("bytes_out")).alias("bytes_total"),
    )


@register(
    "sink_counters",
    f"select cast(count(*) as bigint) as sample from ({_samples_sql(NO_HOSTS)})",
)
def sink_counters(spark, sf_dir):
    """Sample counter; the number of writes depends on the tasks."""
    cut = writers.cut_batches(writers.with_series(_samples(spark, sf_dir)), OPTIONS)
    return observe.sink_counters(cut).select("sample")


@register("throughput_probe")
def throughput_probe(spark, sf_dir):
    rows = windowing.window_rows(tables.flows(spark, sf_dir), OPTIONS)
    return observe.throughput(observe.with_clock(rows), "clock_ms")
