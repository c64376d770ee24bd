"""Time the full load and the headline queries; prints one JSON line.

``landing`` turns the source tables into stored raw lines. ``etl_full`` goes from those raw lines to
the marts (gate and its summary, cleaning, dimensions, facts, marts, all written as Parquet): the
median of three loads after two that warm the JVM up; ``etl_full_cold`` is the first load of the fresh
JVM. The other entries run once on the tables of the last load.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tallybook import catalog  # noqa: E402
from tallybook.operators import quality  # noqa: E402
from tallybook.schemas import FULL_BATCH  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CORES = os.environ.get("BENCH_CPUS", "8")
# Repeated loads come last; none begins after this many seconds, so that the line is always printed.
SECONDS = float(os.environ.get("BENCH_SECONDS", "600"))
LOADS = ("upkept_", "customers_", "incremental_", "streamed_", "latest_batch_", "loaded_", "batch_raw_", "d5_", "fact_sales_sample",
         "constraint_audit")
# What needs fitted models takes minutes of training; BENCH_TRAINING=1 times it as well.
TRAINED = {
    "encoded_categories", "logistic_optimality", "tree_replay", "reloaded_model_agrees", "model_comparison", "model_info",
    "churn_scores", "churn_score_totals", "reloaded_model_scores",
}


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CORES}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CORES)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.codegen.cache.maxEntries", "5000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def load(spark: SparkSession, seconds: dict[str, float], suffix: str = "") -> catalog.Workspace:
    w = catalog.Workspace(spark, FOLDER)
    started = time.time()
    w.raw
    landed = time.time()
    with ThreadPoolExecutor(1) as pool:
        summary = pool.submit(lambda: quality.summary_of(w.gated, FULL_BATCH).collect())
        w.build()
        summary.result()
    seconds["landing" + suffix], seconds["etl_full" + suffix] = landed - started, time.time() - landed
    return w


def main() -> None:
    spark = session()
    seconds: dict[str, float] = {}
    load(spark, seconds, "_cold")
    warm: list[dict[str, float]] = []
    for _ in range(4):
        warm.append({})
        w = load(spark, warm[-1])
    for name in warm[0]:
        seconds[name] = statistics.median(run[name] for run in warm[1:])
    begun = time.time()
    for name, query in sorted(catalog.QUERIES.items(), key=lambda q: q[0].startswith(LOADS)):  # stable
        if name.startswith(LOADS) and time.time() - begun > SECONDS:
            continue
        if name in TRAINED and os.environ.get("BENCH_TRAINING") != "1":
            continue
        started = time.time()
        consume(catalog.plain(query(w)))
        seconds[name] = time.time() - started
    seconds = {n: round(s, 3) for n, s in seconds.items()}
    print(json.dumps({
        "metric": "full load, raw lines to marts", "value": seconds["etl_full"], "unit": "sec",
        "queries": seconds, "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1], "cores": int(CORES),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
