"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data
and cores. Each query is built, planned and run to the last row, twice; the better time
counts, so that class loading is left out.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload.spark_queries import QUERIES  # noqa: E402


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("landfall-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Recording the Python call site of every column operation costs more than most of these queries.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, folder: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    seconds = {}
    for name in QUERIES:
        first = run(spark, folder, name)
        seconds[name] = round(min(first, run(spark, folder, name)), 3)
        print(f"{name}: first {first:.2f}s, counted {seconds[name]:.2f}s", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds of all registered queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
