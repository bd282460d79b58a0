"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from ledgerlens.plans import catalog  # noqa: E402

HEADLINE = [
    "rule_high_value",
    "rule_velocity",
    "rule_structuring",
    "rule_dormant",
    "rule_round_numbers",
    "combined_flags",
    "scored_transactions",
    "scored_transactions_skewed",
    "top_risky",
    "risk_distribution",
    "high_risk_users",
    "risk_report",
    "summary_report",
    "full_run",
    "alerts_insert_ignore",
    "alerts_upsert",
    "feature_matrix",
    "standardised_features",
    "distance_outliers",
    "isolation_forest_flags",
    "kmeans_outliers",
    "confusion_by_method",
    "method_comparison",
    "amount_boxplot",
    "stream_velocity",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerlens-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the executor threads before the clock.
    spark.range(1_000_000).selectExpr("sum(id)").collect()
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog.REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
