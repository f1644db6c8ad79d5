"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the threads.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES

# All thirty days of trips, for the preparations and the routing alike.
HEADLINE = ["nearest_node", "prepared_city", "prepared_city_sentinel", "prepared_external", "prepared_all",
            "od_pairs", "od_batches", "network_for_bins", "routed_trips", "path_rows_streets"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("odflow-bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    # Start the workers and load the classes, so that the first query is not charged for it.
    spark.read.parquet(f"{sf_dir}/nation.parquet").groupBy("n_regionkey").count().collect()
    seconds = {}
    for name in HEADLINE:
        began = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 2)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 2), "unit": "sec",
                      "queries": seconds, "sf": float(scale.group(1)) if scale else None}))


if __name__ == "__main__":
    main()
