"""Seconds per headline query; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Every query is run in full
and its result is written to a sink that discards it. One short query runs first, so that
starting the JVM is not counted as part of any query.
"""

import json
import os
import time

from catalog.queries import all_queries
from surveil.session import build_session

HEADLINE = [
    "valid_vitals", "insert_if_absent_vitals", "reject_reasons", "latency_summary", "case_history",
    "trend_forecast", "piecewise_forecast", "forest_flags", "forest_evaluation", "nearest_region",
    "dbscan_core", "dbscan_labels", "cluster_summary", "region_risk", "latest_risk", "causal_outbreak_flags",
    "headline",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("surveil-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")})
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    queries["label_counts"](spark, folder).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
