"""Times the headline queries and prints one JSON line.

Each query runs once to warm up, then twice (``BENCH_RUNS``); the median counts. Results are written to a sink that reads
every row and column.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sluiceway import configure  # noqa: E402
from sluiceway.plans.queries import QUERIES, STAGED  # noqa: E402
from sluiceway.plans.checkout import checkout_events  # noqa: E402
from sluiceway.session import fresh_path  # noqa: E402
from sluiceway.sources.readers import read_events  # noqa: E402
from sluiceway.streaming import job  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
HEADLINE = (
    "circuit_breaker", "circuit_breaker_by_user", "running_error_rate", "validation_report", "metrics_by_interval",
    "record_failures", "rolling_null_ratio", "expectation_suite", "annotate_dlq", "write_contract", "incidents",
)
STREAM_FILES = 10


def read_all(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def stream_inbox(spark: SparkSession) -> str:
    """The table as ten files, written once for all runs of the stream job."""
    root = fresh_path(spark, "bench-inbox")
    events = checkout_events(spark, SF_DIR).select("event_id", "event_ts", "value")
    events.withColumn("event_ts", events.event_ts.cast("timestamp")).repartitionByRange(
        STREAM_FILES, "event_ts", "event_id").write.parquet(root)
    return root


def stream_job(spark: SparkSession, inbox: str) -> None:
    root = fresh_path(spark, "bench-stream")
    schema = spark.createDataFrame([], STAGED).schema
    events = read_events(spark, "parquet", schema, path=inbox, maxFilesPerTrigger="5")
    job.start(events, root, f"{root}/checkpoint", available_now=True).awaitTermination()


def median_seconds(run) -> float:
    run()
    times = []
    for _ in range(RUNS):
        begin = time.perf_counter()
        run()
        times.append(time.perf_counter() - begin)
    return round(statistics.median(times), 3)


def main() -> None:
    spark = configure(
        SparkSession.builder.master(f"local[{CPUS}]").appName("sluiceway-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds = {name: median_seconds(lambda q=QUERIES[name]: read_all(q(spark, SF_DIR))) for name in HEADLINE}
    inbox = stream_inbox(spark)
    seconds["stream_job"] = median_seconds(lambda: stream_job(spark, inbox))
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, median warm run, summed", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "rows": rows,
        "rows_per_sec": {name: round(rows / s) for name, s in seconds.items()}, "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()
