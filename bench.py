"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_RUNS     warm runs per query, of which the median counts (default 3)
BENCH_EVENTS   folder for Spark's event log; if set, shuffle bytes per query are reported too
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from testbed.queries import QUERIES  # noqa: E402

HEADLINE = (
    "open_po",
    "receipts",
    "forecast_lag1",
    "forecast_wide_all",
    "bom_demand",
    "exception_enriched",
    "rm_inventory",
    "fg_inventory_lot",
    "rm_inventory_balance",
    "fg_inventory_balance",
    "fg_inventory_mfg",
    "weekly_bom_demand",
    "weekly_run",
)


def session(cpus: str, events: str | None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("matflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if events:
        builder = (
            builder.config("spark.eventLog.enabled", "true")
            .config("spark.eventLog.dir", f"file://{events}")
            .config("spark.eventLog.rolling.enabled", "false")
            .config("spark.eventLog.compress", "false")
        )
    return builder.getOrCreate()


def run_once(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def shuffle_bytes(log: Path) -> dict[str, int]:
    """Shuffle bytes written per job group (the group is the query name)."""
    group_of_stage: dict[int, str] = {}
    written: dict[str, int] = {}
    with log.open() as lines:
        for line in lines:
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                group = event.get("Properties", {}).get("spark.jobGroup.id", "")
                group_of_stage.update({stage: group for stage in event["Stage IDs"]})
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                group = group_of_stage.get(event["Stage ID"], "")
                size = event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
                written[group] = written.get(group, 0) + size
    return written


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    events = os.environ.get("BENCH_EVENTS")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "8"), events)
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    for name in HEADLINE:
        spark.sparkContext.setJobGroup(f"{name}:warmup", name)
        run_once(spark, name, sf_dir)
        spark.sparkContext.setJobGroup(name, name)
        times = [run_once(spark, name, sf_dir) for _ in range(runs)]
        timings[name] = round(statistics.median(times), 3)
    result = {
        "metric": "sum of median warm query times",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "runs": runs,
    }
    app = spark.sparkContext.applicationId
    spark.stop()
    if events:
        written = shuffle_bytes(Path(events) / app)
        result["shuffle_bytes"] = {name: written.get(name, 0) // runs for name in HEADLINE}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
