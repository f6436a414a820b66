"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_QUERIES
(comma-separated) other queries than the headline ones.
"""

from __future__ import annotations

import json
import os
import time

import pyspark
from pyspark.sql import SparkSession

from checks.queries import QUERIES

HEADLINE = [
    "scan_items",
    "dataset_overview",
    "column_profile",
    "numeric_profile",
    "categorical_profile",
    "quality_audit",
    "outlier_summary",
    "clean_items",
    "impute_price",
    "seller_features",
    "log_features",
    "robust_scaled",
    "silhouette_sq",
    "silhouette_samples",
    "davies_bouldin",
    "calinski_harabasz",
    "kmeans_evaluation",
    "seller_clusters",
    "cluster_summary",
    "cluster_profile",
    "seller_preview",
    "grain_urls",
    "seller_daily_features",
    "rolling_30d",
    "seller_strategy_mart",
    "price_log_histogram",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = session(cpus)
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": cpus,
        "pyspark": pyspark.__version__,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
