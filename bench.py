"""Time the headline queries, the better of two runs each; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from workload.queries import REGISTRY  # noqa: E402

HEADLINE = (
    "orders_payments_join",
    "chronological_events",
    "validation_labels",
    "route_clean",
    "route_quarantine",
    "dedupe_latest",
    "upsert_silver",
    "upsert_pending",
    "daily_revenue_model",
    "daily_revenue_incremental",
    "customer_activity_model",
    "contract_failures_per_test",
    "expectation_checks",
    "review_pending_status",
    "inspect_report",
    "bronze_append",
    "stream_quarantine",
)

WRITES = ("bronze_append", "stream_quarantine")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:]

    def run(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    def best(name: str) -> float:
        # The second run is free of code generation; stored results are written once.
        return run(name) if name in WRITES else min(run(name), run(name))

    run("daily_revenue_model")  # warm-up
    seconds = {name: best(name) for name in HEADLINE if not only or name in only}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
