"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from netrill.catalog import QUERIES  # noqa: E402
from netrill.session import local_session  # noqa: E402

HEADLINES = (
    "total_exporter_interface",
    "total_exporter_interface_tos",
    "sum_conversation_tos",
    "topk_app",
    "topk_app_tos",
    "topk_host",
    "topk_host_tos",
    "topk_conversation",
    "topk_conversation_tos",
    "all_summaries",
    "topk_with_other",
    "window_stats",
    "reconcile_totals",
    "metrics_include",
    "summary_json",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8, memory="16g")
    spark.sparkContext.setLogLevel("OFF")
    flows = spark.read.parquet(os.path.join(folder, "lineitem.parquet")).count()
    # Warm up, so that the first queries do not pay for loading and compiling.
    for name in ("all_summaries", "metrics_include", "all_summaries"):
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINES:
        started = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - started, 3)
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "flows": flows,
                "all_summaries_flows_per_sec": round(flows / times["all_summaries"]),
            }
        )
    )


if __name__ == "__main__":
    main()
