"""Queries that run the flows through Structured Streaming and read the result.

Each reads the whole table as a stream, or as files that arrive in two parts:
everything but UDP flows first, then the UDP flows, which are late.
"""

from __future__ import annotations

import functools
import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from netrill.catalog.oracle import ITF
from netrill.catalog.records import WIRE_COLUMNS
from netrill.catalog.registry import Query
from netrill.catalog.registry import register as register_query
from netrill.config import FlowOptions
from netrill.operators import aggregate, documents, reducers, reports, windowing
from netrill.plans import groupings as G
from netrill.plans.sums import shape_sums
from netrill.plans.summaries import summaries_of_rows
from netrill.schema import SUMMARY_COLUMNS
from netrill.session import shared_folder
from netrill.sources import kafka, protobuf, tables
from netrill.streaming import counters, panes, quarantine, replay, series, sinks, timed, windows



def register(name: str, select: str | None = None, **parameters: int):
    """Register a query whose streams keep their state in few partitions.

    A stream fixes its number of state partitions when it first starts. In a
    local session the default number is far more than there are slots.
    """

    def add(build: Query) -> Query:
        @functools.wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            setting = "spark.sql.shuffle.partitions"
            before = spark.conf.get(setting)
            if spark.sparkContext.master.startswith("local"):
                slots = spark.sparkContext.defaultParallelism
                spark.conf.set(setting, str(min(int(before), slots)))
            try:
                return build(spark, sf_dir)
            finally:
                spark.conf.set(setting, before)

        return register_query(name, select, **parameters)(run)

    return add


OPTIONS = FlowOptions()
W = OPTIONS.fixed_window_size_ms
PARTS = ("not coalesce(protocol = 17, false)", "protocol = 17")
SUMMARIES = f"select {', '.join(SUMMARY_COLUMNS)} from summaries"
TOTALS = "select * from sum_exporter_interface"
ITF_KEYS = ["window_start", *aggregate.BASE_COLUMNS[1:]]
# Watermark after the first part.
FIRST_WATERMARK = (
    "(select max(last_switched) - 120000 from flows where protocol is null or protocol <> 17)"
)


def _interface_totals(leaf: DataFrame) -> DataFrame:
    return reports.sum_over_panes(leaf.drop("hostname", "hostname2"), ITF_KEYS)


def _parquet_writer(path: str, spark: SparkSession):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(path, f"batch={batch_id}"))

    return write


def _final_leaf(spark: SparkSession, sf_dir: str, options: FlowOptions, parts, drain: bool):
    """Leaf rows of the ``final`` contract, after all parts arrived."""
    folder = shared_folder(spark, "final")
    flows = tables.flows(spark, sf_dir)
    out, checkpoint = f"{folder}/out", f"{folder}/checkpoint"
    write = _parquet_writer(out, spark)

    def begin(stream: DataFrame):
        joined = windows.with_closing(stream, folder)
        return windows.start_final(joined, options, checkpoint, write)

    replay.replay(flows, parts, folder, begin)
    if drain:
        newest = flows.agg(F.max("last_switched").alias("newest")).first().newest
        windows.write_closing(flows, folder, newest, options)
        begin(replay.arrivals(spark, folder, flows.schema)).awaitTermination()
    return spark.read.parquet(out).drop("batch")


@register("src_kafka_flows", f"select {WIRE_COLUMNS} from flows")
def src_kafka_flows(spark, sf_dir):
    """Messages of a topic, here as files, decoded on the stream."""
    folder = shared_folder(spark, "messages")
    messages = protobuf.encode_flows(tables.flows(spark, sf_dir))
    messages.write.parquet(f"{folder}/messages")
    stream = kafka.flow_stream(spark, OPTIONS, f"{folder}/messages")
    write = _parquet_writer(f"{folder}/out", spark)
    windows.start(stream, "append", write, f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch")


@register(
    "event_time_watermark",
    f"{TOTALS} where window_start + {W} <= (select max(window_end) from win) - 180000",
)
def event_time_watermark(spark, sf_dir):
    """Windows that the watermark has closed, without draining the rest."""
    options = FlowOptions(allowed_lateness_ms=0)
    leaf = _final_leaf(spark, sf_dir, options, ["true"], drain=False)
    return _interface_totals(leaf)


@register(
    "unaligned_tumbling_windows",
    "select node_id, window_start, window_end, count(*) as n from win group by all",
)
def unaligned_tumbling_windows(spark, sf_dir):
    """Windows per exporter as a stream assigns them."""
    folder = shared_folder(spark, "unaligned")
    rows = windowing.window_rows(tables.flow_stream(spark, sf_dir), OPTIONS)
    counted = windows.watermarked(rows, OPTIONS).groupBy(
        "closes_at", "node_id", "window_start", "window_end"
    ).agg(F.count("*").alias("n")).drop("closes_at")
    write = _parquet_writer(f"{folder}/out", spark)
    windows.start(counted, "update", write, f"{folder}/checkpoint").awaitTermination()
    newest = spark.read.parquet(f"{folder}/out")
    return newest.groupBy("node_id", "window_start", "window_end").agg(
        F.max_by("n", "batch").alias("n")
    )


def _panes(spark: SparkSession, sf_dir: str, options: FlowOptions, parts=PARTS) -> DataFrame:
    folder = shared_folder(spark, "panes")

    def begin(stream: DataFrame):
        return panes.start_panes(stream, options, f"{folder}/checkpoint", folder)

    following = replay.replay(tables.flows(spark, sf_dir), parts, folder, begin)
    panes.drain(spark, folder, following, options)
    return panes.read_panes(spark, folder)


@register("on_time_pane", TOTALS)
def on_time_pane(spark, sf_dir):
    """All flows in time: every window has one pane, on time."""
    found = _panes(spark, sf_dir, OPTIONS, ["true"])
    return _interface_totals(found.filter(F.col("timing") == panes.ON_TIME))


_PART_SUMS = (
    f"select window_start, {ITF}, cast(sum(bytes_in) as bigint) as bytes_in,"
    " cast(sum(bytes_out) as bigint) as bytes_out, bool_or(congestion_encountered) as"
    " congestion_encountered, bool_or(non_ect) as non_ect from win"
)


@register(
    "late_panes",
    f"{_PART_SUMS} where protocol = 17 and window_end <= {FIRST_WATERMARK} group by all",
)
def late_panes(spark, sf_dir):
    found = _panes(spark, sf_dir, OPTIONS)
    return _interface_totals(found.filter(F.col("timing") == panes.LATE))


@register("early_panes", TOTALS)
def early_panes(spark, sf_dir):
    """Estimates of open windows, on-time and late panes add up to the totals."""
    found = _panes(spark, sf_dir, FlowOptions(early_processing_delay_ms=1000))
    return _interface_totals(found)


@register("discarding_panes", TOTALS)
def discarding_panes(spark, sf_dir):
    return _interface_totals(_panes(spark, sf_dir, OPTIONS))


@register(
    "drop_too_late",
    f"{_PART_SUMS} where protocol is null or protocol <> 17"
    f" or window_end + 600000 > {FIRST_WATERMARK} group by all",
)
def drop_too_late(spark, sf_dir):
    """Late flows count only for the allowed ten minutes."""
    options = FlowOptions(allowed_lateness_ms=600_000)
    return _interface_totals(_panes(spark, sf_dir, options))


@register("checkpoint_restart", SUMMARIES)
def checkpoint_restart(spark, sf_dir):
    """Stopped after the first part and started again: same as one batch run."""
    leaf = _final_leaf(spark, sf_dir, OPTIONS, PARTS, drain=True)
    return summaries_of_rows(leaf, OPTIONS)


@register("drain_bounded_input", TOTALS)
def drain_bounded_input(spark, sf_dir):
    leaf = _final_leaf(spark, sf_dir, OPTIONS, ["true"], drain=True)
    return _interface_totals(leaf)


@register("stream_upsert", SUMMARIES)
def stream_upsert(spark, sf_dir):
    """Summaries kept current while the flows arrive in two parts."""
    folder = shared_folder(spark, "upsert")

    def begin(stream: DataFrame):
        return windows.start_upsert(stream, OPTIONS, f"{folder}/checkpoint", folder)

    replay.replay(tables.flows(spark, sf_dir), PARTS, folder, begin)
    return windows.current_summaries(spark, folder)


_COUNTED = " union all ".join(
    f"select {n} as part, (select count(*) from flows where {part}) as flows_read,"
    f" (select count(*) from win where {part}) as in_window,"
    f" (select count(*) from flows where node_id is null and ({part})) as missing_exporter,"
    f" (select count(*) from shifted where node_id is not null and ds >= shift and ls < ds and ({part}))"
    " as end_before_start,"
    f" (select max(last_switched) from flows where {part}) as newest_switched"
    for n, part in enumerate(PARTS)
)


@register("stream_counters", _COUNTED)
def stream_counters(spark, sf_dir):
    """Counters that a running stream reports, by the part of the input that it ran for."""
    folder, runs = shared_folder(spark, "counters"), []

    def begin(stream: DataFrame):
        write = _parquet_writer(f"{folder}/out", spark)
        runs.append(windows.start_final(stream, OPTIONS, f"{folder}/checkpoint", write))
        return runs[-1]

    with counters.StreamCounters().of(spark) as found:
        replay.replay(tables.flows(spark, sf_dir), PARTS, folder, begin)
        for query in runs:
            found.wait(query)
        batches = found.table(spark)
    order = F.create_map(*[F.lit(x) for n, query in enumerate(runs) for x in (str(query.runId), n)])
    sums = ["flows_read", "in_window", "missing_exporter", "end_before_start"]
    return (
        batches.withColumn("part", order[F.col("run")])
        .where("part is not null")
        .groupBy("part")
        .agg(*[F.sum(name).alias(name) for name in sums], F.max("newest_switched").alias("newest_switched"))
    )


def _pane_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """DSCP totals in two panes per window, written and read as a stream."""
    flows = tables.flows(spark, sf_dir)
    for part in PARTS:
        rows = windowing.window_rows(flows.filter(part), OPTIONS)
        found = series.series_rows(shape_sums(rows, [G.TOS]))
        found.write.mode("append").parquet(f"{folder}/pane-rows")
    schema = spark.read.parquet(f"{folder}/pane-rows").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/pane-rows")


def _until_quiet(stream: DataFrame, folder: str, delay_ms: int) -> DataFrame:
    spark, written = stream.sparkSession, []

    def write(batch: DataFrame, batch_id: int) -> None:
        path = os.path.join(folder, "out", f"batch={batch_id}")
        batch.write.mode("overwrite").parquet(path)
        written.append(spark.read.parquet(path).count())

    query = (
        stream.writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(processingTime="1 second").start()
    )
    replay.run_until_quiet(query, written, delay_s=1 + delay_ms / 1000)
    return spark.read.parquet(f"{folder}/out").drop("batch")


TOS_TOTALS = (
    f"select window_start, {ITF}, dscp, bytes_in, bytes_out from sum_exporter_interface_tos"
)


def _tos_totals(found: DataFrame) -> DataFrame:
    keys = ["window_start", *G.GROUPINGS[G.TOS].columns]
    return found.groupBy(*keys).agg(
        F.sum("bytes_in").alias("bytes_in"), F.sum("bytes_out").alias("bytes_out")
    )


@register("pane_accumulator", TOS_TOTALS)
def pane_accumulator(spark, sf_dir):
    folder = shared_folder(spark, "accumulator")
    stream = _pane_stream(spark, sf_dir, folder)
    keys = ["window_start", *G.GROUPINGS[G.TOS].columns]
    held = series.accumulate_panes(stream, keys, 1000)
    return _tos_totals(_until_quiet(held, folder, 1000))


def _indexed(spark: SparkSession, sf_dir: str, options: FlowOptions) -> DataFrame:
    folder = shared_folder(spark, "series")
    stream = _pane_stream(spark, sf_dir, folder)
    rows = stream.withColumn("window_end", F.col("window_start") + W)
    numbered = series.index_panes(windows.watermarked(rows, options).drop("window_end"), options)
    write = _parquet_writer(f"{folder}/out", spark)
    windows.start(numbered, "append", write, f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch")


@register(
    "stream_pane_index",
    f"""select window_start, {ITF}, dscp, count(*) as samples, count(*) - 1 as highest from
      (select distinct window_start, {ITF}, dscp, coalesce(protocol = 17, false) as part from win)
      group by all""",
)
def stream_pane_index(spark, sf_dir):
    """Panes of equal series and time get increasing indexes."""
    found = _indexed(spark, sf_dir, OPTIONS)
    keys = ["window_start", *G.GROUPINGS[G.TOS].columns]
    return found.groupBy(*keys).agg(
        F.count("*").alias("samples"), F.max("pane").cast("bigint").alias("highest")
    )


@register("accumulating_metric_sink", TOS_TOTALS)
def accumulating_metric_sink(spark, sf_dir):
    options = FlowOptions(metric_accumulation_delay_ms=1000)
    folder = shared_folder(spark, "metric-sink")
    rows = _pane_stream(spark, sf_dir, folder).withColumn(
        "window_end", F.col("window_start") + W
    )
    marked = windows.watermarked(rows, options).drop("window_end")
    return _tos_totals(_until_quiet(series.accumulate_samples(marked, options), folder, 1000))


@register("series_state_gc", TOS_TOTALS)
def series_state_gc(spark, sf_dir):
    """Values held far beyond the run go out when their series is dropped."""
    options = FlowOptions(
        metric_accumulation_delay_ms=3_600_000, allowed_lateness_ms=0, late_processing_delay_ms=1000
    )
    folder = shared_folder(spark, "series-gc")
    rows = _pane_stream(spark, sf_dir, folder).withColumn(
        "window_end", F.col("window_start") + W
    )
    # A closing time past every window drops all series at once.
    last = F.lit(1_704_067_200_000 + 4 * 3_600_000).cast("bigint")
    marked = windows.watermarked(rows.withColumn("window_end", last), options)
    held = series.accumulate_samples(marked.drop("window_end"), options)
    return _tos_totals(_until_quiet(held, folder, 5000))




# Parts of the flows with their time of arrival, on the clock that delays go by.
ARRIVALS = {0: PARTS[0], 100: "protocol = 17 and last_switched % 3 = 0",
            130: "protocol = 17 and last_switched % 3 = 1", 200: "protocol = 17 and last_switched % 3 = 2"}
DAY = 24 * 60 * 60_000
INTERFACE_KEYS = ["window_end", *aggregate.BASE_COLUMNS[1:]]


def _arriving(spark: SparkSession, sf_dir: str, folder: str, options: FlowOptions, start) -> None:
    """Let the parts arrive, each continued by a restarted query, then drain."""
    given = tables.flows(spark, sf_dir)

    def begin(stream: DataFrame):
        joined = windows.with_closing(stream, folder)
        return start(timed.timed_rows(joined, options))

    for at, part in ARRIVALS.items():
        stamped = given.filter(part).withColumn(timed.ARRIVED, F.lit(at).cast("bigint"))
        replay.replay(stamped, ["true"], folder, begin)
    newest = given.agg(F.max("last_switched").alias("newest")).first().newest
    windows.write_closing(stamped, folder, newest, options)
    begin(replay.arrivals(spark, folder, stamped.schema)).awaitTermination()


def _watermark(parts: int) -> str:
    """Up to where records are complete once the first parts are in."""
    came = " or ".join(f"({part})" for part in list(ARRIVALS.values())[:parts])
    return f"(select max(last_switched) - {OPTIONS.default_max_input_delay_ms} from flows where {came})"


@register(
    "timed_panes",
    f"""select window_end, {ITF}, timing, cast(row_number() over (
      partition by window_end, {ITF} order by grp) - 1 as bigint) as pane,
      cast(sum(n) as bigint) as rows, cast(sum(bytes_in) as bigint) as bytes_in,
      cast(sum(bytes_out) as bigint) as bytes_out from (
        select *, case when not late then 0 when part = 2 and 1 = any(parts) then 1 else part end
          as grp, case when late then 'late' else 'on_time' end as timing from (
          select *, list(case when late then part end) over (partition by window_end, {ITF}) as parts
          from (
            select window_end, {ITF}, part, late, count(*) as n, sum(bytes_in) as bytes_in,
              sum(bytes_out) as bytes_out from (
              select *, case part when 0 then false when 1 then window_end <= {_watermark(1)}
                when 2 then window_end <= {_watermark(2)} else window_end <= {_watermark(3)} end as late
              from (select *, case when protocol = 17 then 1 + ls % 3 else 0 end as part from win))
            group by all)))
      group by window_end, {ITF}, grp, timing""",
)
def timed_panes(spark, sf_dir):
    """Every pane as it was fired: late ones 50 ms after their first row, by time of arrival."""
    options = FlowOptions(late_processing_delay_ms=50, allowed_lateness_ms=DAY)
    folder = shared_folder(spark, "timed-panes")
    reducer = reducers.sums_and_flags()

    def start(rows: DataFrame):
        found = timed.timed_panes(rows, options, INTERFACE_KEYS, reducer)
        return timed.start_timed(found, _parquet_writer(f"{folder}/out", spark), f"{folder}/checkpoint")

    _arriving(spark, sf_dir, folder, options, start)
    found = spark.read.parquet(f"{folder}/out")
    return found.select(*INTERFACE_KEYS, "timing", "pane", "rows", "bytes_in", "bytes_out")


def _stamped(rows: DataFrame, options: FlowOptions) -> DataFrame:
    """A pane stream with the watermark and arrival times that held values go by."""
    stamped = rows.withColumn(timed.ARRIVED, F.unix_millis("_metadata.file_modification_time"))
    stamped = stamped.withColumn("window_end", F.col("window_start") + W)
    seen = F.timestamp_millis("window_end")
    return stamped.withColumn(timed.SEEN_AT, seen).withWatermark(
        timed.SEEN_AT, f"{options.default_max_input_delay_ms + timed.slack_ms(options)} milliseconds"
    )


@register(
    "held_samples",
    f"select window_start, {ITF}, dscp, bytes_in, bytes_out, cast(0 as integer) as pane"
    " from sum_exporter_interface_tos",
)
def held_samples(spark, sf_dir):
    """Each value as it was emitted when its series ended: both panes of a time are one sample."""
    options = FlowOptions(metric_accumulation_delay_ms=DAY, allowed_lateness_ms=0)
    folder = shared_folder(spark, "held-samples")
    write = _parquet_writer(f"{folder}/out", spark)

    def run(stream: DataFrame) -> None:
        found = timed.held_samples(_stamped(stream, options), options)
        timed.start_timed(found, write, f"{folder}/checkpoint").awaitTermination()

    stream = _pane_stream(spark, sf_dir, folder)
    run(stream)
    # A record of a series of its own, a day on, ends all others; its own goes on.
    rows = spark.read.parquet(f"{folder}/pane-rows")
    newest = rows.agg(F.max("window_start").alias("window_start")).withColumn("grouped_by", F.lit("closing"))
    more = rows.limit(0).unionByName(newest.withColumn("window_start", F.col("window_start") + DAY), allowMissingColumns=True)
    more.write.mode("append").parquet(f"{folder}/pane-rows")
    run(stream)
    out = spark.read.parquet(f"{folder}/out")
    return out.select("window_start", *G.GROUPINGS[G.TOS].columns, "bytes_in", "bytes_out", "pane")


@register(
    "stream_quarantine",
    """select 'malformed' as reason, count(*) as n from nation union all
      select reason, count(*) from (select case when node_id is null then 'missing_exporter'
        when ds < shift then 'start_before_shift' when ls < ds then 'end_before_start'
        when ls - ds >= 900000 then 'reaches_back' end as reason from shifted)
      where reason is not null group by reason union all
      select 'read', (select count(*) from flows) + (select count(*) from nation) union all
      select 'in_sums', count(*) from (select distinct f from (
        select row_number() over () as f, * from numbered) where ls >= ds)""",
)
def stream_quarantine(spark, sf_dir):
    """Messages read, flows in the sums, and what was left out by reason; the parts add up.

    The names of nations come as messages, too, and are malformed.
    """
    folder = shared_folder(spark, "quarantine")
    messages = protobuf.encode_flows(tables.flows(spark, sf_dir))
    broken = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        F.concat(F.lit("\u007f"), "n_name").cast("binary").alias("value")
    )
    messages.unionByName(broken).write.parquet(f"{folder}/messages")
    options = FlowOptions()
    quarantine.start_messages(
        spark, options, f"{folder}/checkpoint", f"{folder}/out", f"{folder}/messages"
    ).awaitTermination()
    flows = kafka.flow_stream(spark, options, f"{folder}/messages")
    kept = windowing.prepared(flows.filter("node_id is not null"), options)
    kept = kept.filter(windowing.drop_reason(options).isNull()).select("node_id")
    write = _parquet_writer(f"{folder}/kept", spark)
    windows.start(kept, "append", write, f"{folder}/checkpoint-kept").awaitTermination()
    read = spark.read.parquet(f"{folder}/messages").agg(F.count("*").alias("n"))
    sums = spark.read.parquet(f"{folder}/kept").agg(F.count("*").alias("n"))
    found = quarantine.counts(spark, f"{folder}/out").select("reason", "n")
    for name, one in (("read", read), ("in_sums", sums)):
        found = found.unionByName(one.select(F.lit(name).alias("reason"), "n"))
    return found


@register(
    "committed_sinks",
    f"""select window_end, {ITF}, cast(row_number() over (partition by window_end, {ITF} order by part) - 1
        as integer) as pane, bytes_in, bytes_out from (
      select window_start + {W} as window_end, {ITF}, coalesce(protocol = 17, false) as part,
        cast(sum(bytes_in) as bigint) as bytes_in, cast(sum(bytes_out) as bigint) as bytes_out
      from win group by all)""",
)
def committed_sinks(spark, sf_dir):
    """Two batches of panes through all sinks; the second stops half-way and runs again.

    Documents of the interface totals, each with its pane's number from the samples' labels.
    """
    base = shared_folder(spark, "committed")
    options = FlowOptions(documents_path=f"{base}/documents", samples_path=f"{base}/samples")
    flows = tables.flows(spark, sf_dir)
    for batch_id, part in enumerate(PARTS):
        rows = windowing.window_rows(flows.filter(part), options)
        if batch_id:
            sinks.fan_out(rows, options, batch_id, panes_path=f"{base}/series")
        sinks.commit(rows, options, batch_id, base)
    # What a batch that never got whole has left is not seen.
    sinks.fan_out(windowing.window_rows(flows.limit(5), options), options, 2, panes_path=f"{base}/series")
    found = sinks.committed(spark, spark.read.parquet(f"{base}/samples"), base)
    totals = documents.parse_documents(
        sinks.committed(spark, spark.read.text(f"{base}/documents"), base)
    ).filter(F.col("grouped_by") == G.INTERFACE)
    keys = ["node_id", "if_index"]
    numbers = found.filter(F.col("labels")["__name__"] == G.INTERFACE).select(
        "batch",
        (F.col("ts_ms") + 1).alias("range_end"),
        F.col("labels")["nodeId"].cast("int").alias("node_id"),
        F.col("labels")["ifIndex"].cast("int").alias("if_index"),
        F.col("labels")["pane"].cast("int").alias("pane"),
    ).distinct()
    joined = totals.join(numbers, ["batch", "range_end", *keys])
    return joined.select(
        F.col("range_end").alias("window_end"), "node_id", "foreign_source", "foreign_id", "if_index", "pane",
        F.col("bytes_ingress").alias("bytes_in"), F.col("bytes_egress").alias("bytes_out"),
    )
