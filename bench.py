"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from lapsewatch import catalog

HEADLINE = [
    "churn_rate_by_snapshot", "churn_labels_long", "expiry_snapshots", "latest_transaction", "activity_features",
    "activity_features_inclusive", "recency", "asof_latest_long", "transaction_features", "members_asof", "feature_store",
    "training_set", "inference_features", "iqr_clean", "iqr_clean_sketch", "dedup", "bronze_merge", "distribution_by_year",
    "quantile_profile_lines", "null_profile", "stratified_split", "assign_folds", "standardise", "score_summary", "psi",
    "ks", "roc_auc", "monitoring_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t0, 3)

    run(names[0])  # JVM warm-up
    times = {name: run(name) for name in names}
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
