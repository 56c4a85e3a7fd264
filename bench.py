"""Headline timings on one local Spark. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS (default 8) the cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from flowguard.ml.iforest import IsolationForest
from flowguard.plans.suite import load_suite
from flowguard.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINES = [
    "a07_csv_fields_48", "w01_trailing_mean_dense", "w02_trailing_distinct_dense", "w03_source_moments_dense",
    "w04_source_distinct_dense", "w06_plain_burst_sketch", "w07_relational_burst_sketch", "w08_filtered_burst_sketch",
    "w08_filtered_burst_exact", "d01_merge_connections", "e06_fuse_results", "e11_retrained_cutoff", "e17_roc_auc",
    "e16_wasserstein", "c08_shared_address_codes", "c12_syslog_fields", "m06_tfidf", "m18_dense_training",
]


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "flowguard-bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__driver__memory="20g",
        spark__ui__showConsoleProgress="false", spark__sql__adaptive__coalescePartitions__minPartitionSize="128KB",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load_suite()
    times: dict[str, float] = {}
    run(queries["e01_row_count"](spark, FOLDER))  # start the JVM and the Python workers
    for name in HEADLINES:
        started = time.time()
        run(queries[name](spark, FOLDER))
        times[name] = round(time.time() - started, 3)

    # The shape of the published forest timings: about 570,000 rows of 3 numbers, 100 trees of 256 rows.
    rows = spark.read.parquet(f"{FOLDER}/lineitem.parquet").select(
        F.array("l_quantity", "l_extendedprice", "l_discount").alias("features")
    ).repartition(int(CPUS)).persist()
    rows.count()
    started = time.time()
    model = IsolationForest(numTrees=100, maxSamples=256, seed=1, approxQuantileRelativeError=0.001).fit(rows)
    times["iforest_fit"] = round(time.time() - started, 3)
    started = time.time()
    run(model.transform(rows))
    times["iforest_predict"] = round(time.time() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"), "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
