"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Each query runs once to warm up and
then three times into the noop sink, which computes every row; its median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from agrilake.session import configure
from catalog.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = [
    "gold_daily",
    "rolling_metrics",
    "risk_flags",
    "array_normalize",
    "typed_cast",
    "silver_filter",
    "silver_dedup",
    "quality_split",
    "dq_report",
    "agri_silver",
    "agri_gold",
    "fact_weather",
    "fact_upsert",
    "star_read",
    "risk_summary",
    "trend_top_cities",
    "agri_climate",
    "agro_score",
]


def seconds(spark: SparkSession, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    names = sys.argv[1:] or HEADLINE
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
    builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "5g")
    builder = builder.config("spark.sql.shuffle.partitions", CPUS if CPUS.isdigit() else "8")
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        seconds(spark, name)
        timings[name] = round(statistics.median(seconds(spark, name) for _ in range(RUNS)), 3)
    spark.stop()
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "total", "value": total, "unit": "sec", "queries": timings, "sf": SF_DIR}))


if __name__ == "__main__":
    main()
