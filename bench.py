"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set data and cores.
Every query is run in full and its result written to a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = """
scaler_fit_transform onehot_fit_transform laplace_fit_transform special_fit_transform special_back impute_random
boxcox_fit_transform splitcap_fit_transform draw_minibatches dense_forward generate_conditional score_realness
gini accuracy_index diagonal_cmv ks2d energy estat preprocess_pipeline postprocess_pipeline
""".split()


def main() -> None:
    from pyspark.sql import SparkSession

    from suite.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["read_columns"](spark, sf_dir).count()  # starts the executors
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        started = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - started, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir)}
        )
    )


if __name__ == "__main__":
    main()
