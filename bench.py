"""Wall time of the headline queries: best of three runs after one to warm up.

Prints one JSON line. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the threads.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from stayline.plans.catalog import QUERIES

HEADLINE = (
    "share_by_gender",
    "hist_plays",
    "box_plays",
    "feature_table",
    "cv_leaderboard",
    "user_facts",
    "enriched_log",
    "churn_running",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stayline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    best = {}
    for name in HEADLINE:
        run(name)
        best[name] = round(min(run(name) for _ in range(RUNS)), 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": best,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
