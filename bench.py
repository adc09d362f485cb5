"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the cores. Every query is
timed from the parquet scan to its last row, into a sink that drops the rows.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tickloom.workload import QUERIES

HEADLINE = [
    "price_stats",
    "indicator_bundle",
    "ind_ema",
    "ind_sma",
    "sorted_series",
    "new_bars_antijoin",
    "dedupe_batch",
    "validate_prices",
    "fact_stock_prices",
    "upsert_prices",
    "ingest_incremental",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tickloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
