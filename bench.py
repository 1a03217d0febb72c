"""Times the headline queries and prints one JSON line.

Each query is run to full materialisation; the first run warms up, then the median of
``BENCH_RUNS`` is taken.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from workload import catalog

HEADLINE = (
    "kpi_record_fused", "kpi_record", "kpi_retry_count_total", "kpi_incident_count_element", "kpi_duration",
    "kpi_latency_total", "kpi_latency_element", "kpi_user_task_sla_desc", "kpi_assignee_all",
    "current_variables", "kpi_threshold_date", "call_closure", "flow_topology", "flow_source_asof", "topology_rank",
    "history_topk", "history_json", "history_string", "stream_trigger", "stream_close",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    times = {}
    for name in wanted.split(",") if wanted else HEADLINE:
        measured = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            measured.append(time.perf_counter() - start)
        times[name] = round(statistics.median(measured[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
