"""Time the headline jobs and print one JSON line.

Each job is built and run to completion into a no-op sink; the figure is the
better of two runs after one warm-up of the session. Training is run once.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tremorlake.checks.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "scan_geojson_feed",
    "scan_all_snapshots",
    "clean_events",
    "quality_report",
    "dedup_source_priority",
    "mainshock_isolation",
    "aftershock_pairs",
    "build_feature_table",
    "time_split",
    "tomek_links",
    "smote_oversample",
    "average_precision",
    "roc_auc",
    "classification_report",
    "magnitude_describe",
    "drift_quick_check",
    "drift_report",
    "stream_ingest_dedup",
)
# Run once: each fits a hundred trees or more.
ONCE = ("train_gbt", "batch_score", "train_variations")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(name: str, spark: SparkSession) -> float:
    start = time.perf_counter()
    run(QUERIES[name](spark, SF_DIR))
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark.read.parquet(f"{SF_DIR}/events.parquet").groupBy("user_id").agg(F.count("*")))
    seconds = {name: round(min(timed(name, spark) for _ in range(2)), 3) for name in HEADLINE}
    seconds.update({name: round(timed(name, spark), 3) for name in ONCE})
    found = re.search(r"sf([0-9.]+)", SF_DIR)
    report = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(found.group(1)) if found else SF_DIR,
        "cpus": int(CPUS),
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
