"""Times the headline queries on ``local[$BENCH_CPUS]`` and prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from ampledger.plans.catalog import QUERIES  # noqa: E402
from ampledger.session import SESSION_CONF  # noqa: E402

HEADLINE = [
    "region_kpis",
    "fleet_kpis",
    "rolling_avg_temp",
    "fleet_batch_job",
    "sequences",
    "shape_features",
    "isolation_forest",
    "daily_anomaly_run",
    "ks_drift_report",
    "drift_job",
    "contamination_threshold",
    "inject_faults",
    "scan_json_readings",
    "batch_summary",
    "stream_score",
    "stream_fleet_hourly",
    "rolling_features_sliced",
]


def session(cpus: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    conf = {
        **SESSION_CONF,
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    # Start the session and its Python workers outside the measured part.
    QUERIES["row_count"](spark, sf_dir).collect()
    spark.range(1000).mapInPandas(lambda batches: batches, "id bigint").count()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
