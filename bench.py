"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set data and cores. Each
query runs once to warm up on the smallest data and once timed, all columns read (noop sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from broadsheet.plans.catalog import QUERIES  # noqa: E402

HEADLINES = (
    "digest_core",
    "digest_full",
    "listing",
    "norm_articles",
    "date_notations",
    "dedup_url_first",
    "dedup_greedy",
    "mirror_triage",
    "rank_tier_date",
    "search_boolean",
    "search_near",
    "relevance_rules",
    "rss_items",
    "gdelt_items",
    "page_lines",
    "official_pages",
)
WARM_UP = "/root/testdata/sf0.001"


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("broadsheet-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Building an expression costs a stack inspection per call otherwise.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINES:
        if os.path.isdir(WARM_UP):
            run(spark, name, WARM_UP)
        seconds[name] = round(run(spark, name, sf_dir), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
