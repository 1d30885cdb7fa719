"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs, the median counts (default 3; a query whose untimed run took over BENCH_LONG seconds gets one)
BENCH_WARMUP  untimed runs of each query before (default 1)
BENCH_LONG    see BENCH_RUNS (default 8)
BENCH_QUERIES comma-separated subset
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload.document_queries import QUERIES, scratch  # noqa: E402
from workload import views  # noqa: E402

HEADLINE = (
    "dash_daily_overview", "rejected_llm_request", "summary_feature_daily", "summary_feature_hourly", "summary_session_daily",
    "summary_agent_team_daily", "summary_retrieval_daily", "summary_feedback_daily", "summary_evaluation_daily",
    "summary_team_cost_daily", "summary_prompt_version_daily", "mart_daily_budget", "mart_weekly_summary", "mart_trace_health",
    "mart_experiment_comparison", "adapter_generation_requests", "adapter_trace_retrievals", "stream_feature_hourly",
)


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(run, runs: int, warmup: int) -> float:
    took = []
    for _ in range(warmup):
        started = time.perf_counter()
        run()
        took.append(time.perf_counter() - started)
    if took and took[-1] > float(os.environ.get("BENCH_LONG", "8")):
        runs = 1
    took = []
    for _ in range(runs):
        started = time.perf_counter()
        run()
        took.append(time.perf_counter() - started)
    return round(statistics.median(took), 3)


def backfill_seconds(spark: SparkSession, sf_dir: str, runs: int, warmup: int) -> tuple[float, int]:
    """JSON lines to typed, validated facts, rejects and the daily summary."""
    from lampyris.plans.backfill import backfill_requests

    root = scratch(spark)
    source = views.view(spark, sf_dir, "llm_request")
    source.write.json(f"{root}/raw")
    rows = spark.read.text(f"{root}/raw").count()
    return timed(lambda: backfill_requests(spark, f"{root}/raw", f"{root}/warehouse"), 1, 0), rows  # bound by 2,400 directory commits


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    warmup = int(os.environ.get("BENCH_WARMUP", "1"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(HEADLINE)
    spark = session(cpus)
    results = {}
    for name in wanted:
        if name in QUERIES:
            results[name] = timed(lambda n=name: consume(QUERIES[n](spark, sf_dir)), runs, warmup)
            print(f"{name} {results[name]}", file=sys.stderr, flush=True)
    extra = {}
    if not os.environ.get("BENCH_QUERIES"):
        seconds, rows = backfill_seconds(spark, sf_dir, runs, warmup)
        results["backfill_requests_json"] = seconds
        extra = {"backfill_rows": rows, "backfill_rows_per_sec": round(rows / seconds)}
    line = {
        "metric": "total_seconds_headline_queries", "value": round(sum(results.values()), 3), "unit": "sec", "queries": results,
        "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus, "runs": runs, **extra,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
