"""Flow records derived from the TPC-H style ``lineitem`` table.

The same select list runs in Spark and in DuckDB, so a query here and its
check there start from identical records.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

FLOW_SELECT = {
    "node_id": "cast(case when l_orderkey % 97 = 0 then null else 1 + l_suppkey % 5 end as int)",
    "foreign_source": "case when l_suppkey % 5 = 2 then '' else 'FS' end",
    "foreign_id": "case when l_suppkey % 5 = 2 then '' else concat('fid', 1 + l_suppkey % 5) end",
    "direction": "case when l_returnflag = 'R' then 'EGRESS' else 'INGRESS' end",
    "input_snmp_ifindex": "cast(10 + l_partkey % 2 as int)",
    "output_snmp_ifindex": "cast(20 + l_partkey % 2 as int)",
    "dscp": "cast(case when l_linenumber % 4 = 3 then null else l_linenumber % 4 end as int)",
    "ecn": "cast(case when l_orderkey % 5 = 4 then null else l_orderkey % 5 end as int)",
    "application": "case when l_partkey % 11 = 0 then '' else concat('app', l_partkey % 25) end",
    "protocol": "cast(case when l_partkey % 13 = 0 then null when l_partkey % 2 = 0 then 6"
    " else 17 end as int)",
    "location": "'Default'",
    "src_address": "case when l_partkey % 19 = 0 then '' else concat('10.0.0.', l_suppkey % 30) end",
    "dst_address": "concat('10.0.0.', l_orderkey % 40)",
    "src_hostname": "case when l_partkey % 3 = 0 then ''"
    " else concat('host', l_suppkey % 30, '-', l_partkey % 2) end",
    "dst_hostname": "case when l_partkey % 7 = 0 then null"
    " else concat('host', l_orderkey % 40, '-', l_linenumber % 2) end",
    "num_bytes": "cast(l_quantity as bigint) * 1000 + 7",
    "sampling_interval": "case when l_linenumber = 1 then cast(2.5 as double)"
    " when l_linenumber = 2 then cast(0 as double)"
    " when l_linenumber = 3 then null else cast(1 as double) end",
    "first_switched": "1704067200000 + (l_orderkey * 7919 + l_linenumber * 104729"
    " + l_partkey * 31) % 3600000 - (l_partkey * 37 + l_orderkey) % 180000",
    "delta_switched": "case when l_linenumber = 6 then null else 1704067200000"
    " + (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 3600000"
    " - (l_partkey * 37 + l_orderkey) % 180000 end",
    "last_switched": "1704067200000 + (l_orderkey * 7919 + l_linenumber * 104729"
    " + l_partkey * 31) % 3600000",
}


def flow_expressions() -> list[str]:
    return [f"{text} as {name}" for name, text in FLOW_SELECT.items()]


def flows_sql() -> str:
    """The view as one statement."""
    return "select " + ",\n  ".join(flow_expressions()) + "\nfrom lineitem"


def spread(table: DataFrame, *columns: str) -> DataFrame:
    """Redistribute a table that has fewer splits than the cluster has slots.

    A table of any size has more splits than that and is left alone.
    """
    slots = table.sparkSession.sparkContext.defaultParallelism
    if table.rdd.getNumPartitions() >= slots:
        return table
    return table.repartition(slots, *columns)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded flow records."""
    lines = spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")
    return lines.selectExpr(*flow_expressions())


def flow_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1000) -> DataFrame:
    """The same records as an unbounded table."""
    schema = table(spark, sf_dir, "lineitem").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "lineitem.parquet")
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(sf_dir)
        .selectExpr(*flow_expressions())
    )
