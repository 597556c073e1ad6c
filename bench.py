"""Time the headline queries: one warm-up, then the median of three runs, each writing to a null sink."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from etalage import release  # noqa: E402
from etalage.plans.queries import queries  # noqa: E402

HEADLINE = [
    "monthly_revenue", "top_products", "store_performance", "rfm_quantile", "rfm_ntile", "dedup_transactions",
    "iqr_outliers", "clean_transactions", "clean_clients", "sales_mart", "client_mart", "product_mart",
    "quality_report", "upsert_table",
]


def session(cpus: str) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
             .config("spark.driver.memory", "8g")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(run, spark: SparkSession, folder: str) -> float:
    start = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def shuffled(spark: SparkSession) -> int:
    """Shuffle bytes that the session has written so far."""
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    rows = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    chosen = sys.argv[1:] or HEADLINE
    timings, shuffle_mb = {}, {}
    for name in chosen:
        run = queries()[name]
        before = shuffled(spark)
        seconds(run, spark, folder)
        time.sleep(0.5)  # the status store follows a little later
        shuffle_mb[name] = round((shuffled(spark) - before) / 1e6, 1)
        timings[name] = round(statistics.median(seconds(run, spark, folder) for _ in range(3)), 3)
        release(spark)
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "headline queries, sum of medians", "value": total, "unit": "sec", "queries": timings,
                      "shuffle_mb": shuffle_mb, "rows_per_sec": {name: round(rows / t) for name, t in timings.items()},
                      "fact_rows": rows, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
