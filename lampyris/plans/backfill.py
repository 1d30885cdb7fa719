"""Batch jobs: raw files to facts, rejects, summaries and the run ledger."""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lampyris.contracts import CONTRACTS, LLM_REQUEST
from lampyris.plans import facts, summaries
from lampyris.plans.adapters import generations, traces, trajectories
from lampyris.sources import readers, writers


def load_fact(
    spark: SparkSession, raw: DataFrame, fact: str, path: str, start: str | None = None, end: str | None = None,
    load_id: str | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """Type, validate and store one fact; returns the stored valid rows and counts.

    A date range leaves out rows of other dates; rows without a date lie in no
    range, so they are judged and counted with every load, but stored once per
    input: they stand under ``load_id``, which follows from the input's files
    where none is given.
    """
    checked = facts.validated(raw, fact, fill_nulls=True)
    ranged = readers.between_dates(checked, start, end, or_undated=True)
    counts = writers.write_validated(ranged, path, f"load_{fact}", load_id or input_id(raw))
    return writers.read_valid(spark, path, CONTRACTS[fact].schema), counts


def input_id(raw: DataFrame) -> str | None:
    """One id for the files a frame reads, whatever range of them is loaded; None for rows that come from no file."""
    files = sorted(raw.inputFiles())
    return hashlib.sha256("\n".join(files).encode()).hexdigest()[:32] if files else None


def backfill_requests(
    spark: SparkSession,
    input_path: str,
    warehouse: str,
    start: str | None = None,
    end: str | None = None,
    load_id: str | None = None,
) -> dict[str, int]:
    """JSON lines to request facts, rejects and the daily feature summary.

    The text is parsed once.  The summary reads the stored columns it needs and
    replaces only the dates it covers.
    """
    began = datetime.now(timezone.utc)
    raw = readers.json_lines(spark, input_path, LLM_REQUEST)
    valid, counts = load_fact(spark, raw, "llm_request", f"{warehouse}/llm_request", start, end, load_id)
    written = Observation("feature_daily")
    daily = summaries.feature_daily(readers.between_dates(valid, start, end))
    writers.overwrite_dates(daily.observe(written, F.count(F.lit(1)).alias("n")), f"{warehouse}/feature_daily")
    result = {
        "input_rows": counts["input_rows"],
        "fact_rows": counts["valid_rows"],
        "summary_rows": int(written.get["n"]),
        "quarantine_rows": counts["rejected_rows"],
    }
    writers.record_run(
        spark, f"{warehouse}/pipeline_runs", "request_backfill", "summary", began, datetime.now(timezone.utc),
        result["input_rows"], result["summary_rows"], result["quarantine_rows"],
    )
    return result


# fact -> (summary name, builder) for facts summarised on their own
_DOMAIN_SUMMARIES = {
    "llm_request": ("feature_daily", summaries.feature_daily),
    "retrieval": ("retrieval_daily", summaries.retrieval_daily),
    "feedback": ("feedback_daily", summaries.feedback_daily),
    "guardrail": ("guardrail_daily", summaries.guardrail_daily),
    "evaluation": ("evaluation_daily", summaries.evaluation_daily),
}


def load_domains(spark: SparkSession, raw: dict[str, DataFrame], warehouse: str) -> dict[str, dict[str, int]]:
    """Several domains from raw rows to stored facts and daily summaries."""
    results = {}
    for fact, frame in raw.items():
        valid, counts = load_fact(spark, frame, fact, f"{warehouse}/{fact}")
        if fact in _DOMAIN_SUMMARIES:
            name, build = _DOMAIN_SUMMARIES[fact]
            writers.overwrite_dates(build(valid), f"{warehouse}/{name}")
        results[fact] = counts
    return results


def import_generations(spark: SparkSession, input_path: str, output_path: str, quarantine_path: str) -> dict[str, int]:
    """Generation documents to request rows and rejects, with three counts."""
    lines = spark.read.text(input_path)
    seen = Observation("generation_lines")
    normalized = generations.normalize(lines.observe(seen, F.count(F.lit(1)).alias("n")))
    staged = f"{output_path}_staged"
    # Stored once, then split: the documents are parsed a single time.
    normalized.write.mode("overwrite").partitionBy("_dq_status").parquet(staged)
    stored = spark.read.schema(normalized.schema).parquet(staged)
    valid, rejected = Observation("valid"), Observation("rejected")
    n = F.count(F.lit(1)).alias("n")
    generations.requests(stored).observe(valid, n).write.mode("overwrite").parquet(output_path)
    generations.rejects(stored).observe(rejected, n).write.mode("overwrite").parquet(quarantine_path)
    return {
        "input_rows": int(seen.get["n"]),
        "output_rows": int(valid.get["n"]),
        "quarantine_rows": int(rejected.get["n"]),
    }


def import_trajectories(spark: SparkSession, input_path: str, output_path: str) -> dict[str, int]:
    """Trajectory documents to agent runs, spans, tool calls and rejects.

    Documents are parsed and laid out once, with one clock reading for those
    without a timestamp, and stored; the outputs are read from there.
    """
    lines = spark.read.text(input_path)
    laid_out = trajectories.documents(lines)
    staged = f"{output_path}_staged"
    laid_out.write.mode("overwrite").parquet(staged)
    stored = spark.read.schema(laid_out.schema).parquet(staged)
    n = F.count(F.lit(1)).alias("n")
    counts = {}
    for name, build in (("runs", trajectories.runs), ("spans", trajectories.spans), ("tool_calls", trajectories.tool_calls)):
        seen = Observation(name)
        writers.overwrite_dates(build(stored).observe(seen, n), f"{output_path}/{name}")
        counts[name] = int(seen.get["n"])
    rejected = Observation("rejects")
    trajectories.rejects(lines).observe(rejected, n).write.mode("overwrite").parquet(f"{output_path}/rejects")
    return counts | {"rejects": int(rejected.get["n"])}


def import_traces(spark: SparkSession, input_path: str, output_path: str) -> dict[str, int]:
    """Trace documents to facts and rejects; documents are parsed once and stored in between."""
    lines = spark.read.text(input_path)
    parsed = traces.documents(lines)
    staged = f"{output_path}_staged"
    parsed.write.mode("overwrite").parquet(staged)
    stored = spark.read.schema(parsed.schema).parquet(staged)
    n = F.count(F.lit(1)).alias("n")
    counts = {}
    for name, rows in traces.facts(stored).items():
        seen = Observation(name)
        writers.overwrite_dates(rows.observe(seen, n), f"{output_path}/{name}")
        counts[name] = int(seen.get["n"])
    rejected = Observation("rejects")
    broken = traces.unparsable_documents(lines)
    traces.rejects(stored).unionByName(broken, allowMissingColumns=True).observe(rejected, n).write.mode("overwrite").parquet(f"{output_path}/rejects")
    return counts | {"rejects": int(rejected.get["n"])}
