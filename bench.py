"""Time the headline queries; prints one JSON line.

Every query runs over whole tables into a sink that discards the rows, so the
whole result is computed.  The first run of a query compiles its code and is
not counted; the figure is the better of the next two.  Two queries run before
the clock starts, to warm the JVM up.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marlstone.workload.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "daily_revenue_by_category",
    "customer_lifetime_value",
    "conversion_funnel",
    "cohort_retention",
    "order_enriched",
    "customer_360",
    "fct_daily_revenue",
    "fct_conversion_funnel",
    "dim_products",
    "dim_customers",
    "dedup_latest",
    "clean_orders",
    "clean_order_items",
    "scd2_merge",
    "ntile_distributed",
    "preferred_category",
    "revenue_by_category",
    "customer_summary",
    "null_profile",
    "check_unique",
    "suite_stg_order_items",
    "bronze_job_orders",
    "silver_job_orders",
    "history_job_silver",
    "gold_job_daily_revenue",
]


def seconds(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name].build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    for name in ("order_enriched", "daily_revenue_by_category"):
        seconds(spark, name, folder)
    timings = {}
    for name in names:
        seconds(spark, name, folder)
        timings[name] = round(min(seconds(spark, name, folder) for _ in range(2)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
