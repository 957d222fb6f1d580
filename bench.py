"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all).
Each query runs once untimed and then three times, of which the median counts. The
queries of a fitted model share one, fitted in the untimed run of the first;
``train`` times the fitting itself.
"""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from checks.spark_queries import queries
from haemoloom.plans import classifier
from haemoloom.runtime import SESSION_CONF, scratch_path

RUNS = 3

HEADLINE = [
    "sessionize",
    "sessionize_serving",
    "features_full",
    "features_coarse",
    "features_wide_bins",
    "features_serving",
    "join_registration",
    "join_enrich",
    "agg_time_bins",
    "win_gap",
    "win_new_session",
    "win_session_ordinal",
    "win_rolling_stddev",
    "win_label_lookahead",
    "flt_session_bulk",
    "agg_session_risk",
    "agg_class_weights",
    "src_csv_typed",
    "sink_payload_json",
    "sink_sessionized",
    "sink_features",
    "ml_evaluate",
    "ml_predict",
    "ml_csv_to_risk",
]


def seconds_of(action) -> float:
    begin = time.perf_counter()
    action()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config(map=SESSION_CONF)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run = queries()
    seconds = {}
    for name in HEADLINE:
        query = lambda name=name: run[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        query()
        seconds[name] = round(statistics.median(seconds_of(query) for _ in range(RUNS)), 3)
    path = scratch_path(spark, "bench-features")
    run["features_full"](spark, sf_dir).write.parquet(path)
    seconds["train"] = round(seconds_of(lambda: classifier.train(spark.read.parquet(path))), 3)
    spark.stop()
    print(
        json.dumps({
            "metric": "headline_total",
            "value": round(sum(seconds.values()), 3),
            "unit": "sec",
            "queries": seconds,
            "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        })
    )


if __name__ == "__main__":
    main()
