"""Sinks: partition overwrite, validated output, publishing, export and run ledger."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lampyris.contracts import LLM_REQUEST
from lampyris.operators.quality import REJECTED, STATUS, VALID

# --- Fixed values: columns of the published tables, in order -------------------
PUBLISHED_COLUMNS: dict[str, tuple[str, ...]] = {
    "feature_daily": tuple(
        "date app_name feature_name model_name request_count success_count error_count prompt_tokens completion_tokens "
        "total_tokens estimated_cost_usd avg_latency_ms max_latency_ms p95_latency_ms".split()
    ),
    "model_dimension": tuple(
        "model_name provider input_price_per_1m_tokens output_price_per_1m_tokens max_context_tokens release_date status".split()
    ),
    "access_audit": tuple(
        "date audit_event_id user_id action_type resource_type resource_id ip_address access_granted denial_reason "
        "data_classification created_at".split()
    ),
    "data_retention": tuple(
        "date retention_event_id table_name partition_date action_type rows_affected policy_name created_at".split()
    ),
    "handoff_daily": tuple(
        "date parent_agent_id child_agent_id handoff_type handoff_cnt_1d success_cnt_1d error_cnt_1d timeout_cnt_1d "
        "avg_handoff_latency_ms p95_handoff_latency_ms".split()
    ),
    "platform_health_daily": tuple("date component metric_name metric_value threshold is_breach".split()),
    "weekly_summary": (
        "week_start_date", "app_name", "request_cnt_1w", "success_cnt_1w", "error_cnt_1w", "total_token_cnt_1w", "llm_cost_amt_1w",
        "p95_latency_ms_max", "agent_run_cnt_1w", "agent_success_cnt_1w", "agent_error_cnt_1w", "agent_cost_amt_1w",
        "retrieval_cnt_1w", "retrieval_returned_cnt_1w", "retrieval_hit_cnt_1w", "feedback_cnt_1w", "thumbs_up_cnt_1w",
        "thumbs_down_cnt_1w", "guardrail_check_cnt_1w", "guardrail_triggered_cnt_1w", "guardrail_block_cnt_1w",
        "evaluation_cnt_1w", "evaluation_pass_cnt_1w", "evaluation_fail_cnt_1w", "avg_latency_ms", "retrieval_hit_rate_1w",
        "satisfaction_rate_1w", "evaluation_pass_rate_1w", "avg_evaluation_score", "total_ai_cost_amt_1w",
    ),
    "trace_health": (
        "date", "trace_id", "run_id", "span_id", "request_id", "tool_call_id", "retrieval_id", "app_name", "feature_name", "user_id",
        "session_id", "agent_id", "agent_name", "model_name", "provider", "knowledge_base_id", "bottleneck_node_type",
        "bottleneck_node_id", "bottleneck_name", "bottleneck_status", "bottleneck_error_type", "bottleneck_latency_ms",
        "bottleneck_cost_usd", "bottleneck_input_size", "bottleneck_output_size", "prompt_hash", "response_hash",
        "query_text_hash", "trace_latency_ms", "trace_cost_usd", "trace_total_tokens", "trace_status", "is_high_cost_trace",
        "is_slow_trace", "is_failed_trace", "has_failed_child_observation", "has_slow_child_observation",
        "has_missing_child_facts", "declared_llm_call_count", "observed_llm_request_count", "declared_tool_call_count",
        "observed_tool_call_count", "declared_retrieval_count", "observed_retrieval_count", "child_observation_summary",
    ),
    "experiment_regression": (
        "dataset_name", "experiment_name", "baseline_variant", "candidate_variant", "baseline_model_name",
        "baseline_prompt_version", "candidate_model_name", "candidate_prompt_version", "evaluation_dimension",
        "experiment_start_date", "experiment_end_date", "baseline_evaluation_count", "baseline_pass_count",
        "baseline_fail_count", "baseline_score_numerator", "baseline_score_denominator", "baseline_latency_ms_numerator",
        "baseline_latency_ms_denominator", "baseline_estimated_cost_usd_numerator", "baseline_estimated_cost_usd_denominator",
        "candidate_evaluation_count", "candidate_pass_count", "candidate_fail_count", "candidate_score_numerator",
        "candidate_score_denominator", "candidate_latency_ms_numerator", "candidate_latency_ms_denominator",
        "candidate_estimated_cost_usd_numerator", "candidate_estimated_cost_usd_denominator",
    ),
}
# Columns of the tab-separated request export: the contract with the raw texts
# after the provider.
_PROVIDER = LLM_REQUEST.columns.index("provider") + 1
EXPORT_COLUMNS = (*LLM_REQUEST.columns[:_PROVIDER], "prompt_text", "response_text", *LLM_REQUEST.columns[_PROVIDER:])


def overwrite_dates(frame: DataFrame, path: str, by: Sequence[str] = ("date",)) -> None:
    """Replace only the partitions present in ``frame``; safe to re-run.

    Rows are brought together by partition first, so a date is written by few
    tasks; adaptive execution splits a date that is much larger than others.
    """
    grouped = frame.hint("rebalance", *by)
    writer = grouped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def overwrite_table_dates(frame: DataFrame, table: str) -> None:
    """Dynamic partition overwrite of a catalog table."""
    frame.writeTo(table).overwritePartitions()


def overwrite_all(frame: DataFrame, path: str) -> None:
    """Replace an unpartitioned snapshot (dimensions, experiment mart)."""
    frame.write.mode("overwrite").parquet(path)


LOAD = "_load"


def write_validated(validated: DataFrame, path: str, name: str = "validated", load_id: str | None = None) -> dict[str, int]:
    """Valid and rejected rows side by side per date in one pass; returns counts.

    Rows without a date stand under the load that brought them, so another load
    leaves them alone; a load that is repeated under the same ``load_id``
    replaces its own.

    The source is scanned once: both kinds come from one write and the counts
    from metrics observed while writing.  Status is a stored column rather than
    a directory, so loading a date again replaces its valid and its rejected
    rows together, also when one kind is gone.
    """
    seen = Observation(name)
    observed = validated.observe(
        seen,
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(F.col(STATUS) == VALID).alias("valid_rows"),
        F.count_if(F.col(STATUS) == REJECTED).alias("rejected_rows"),
    )
    undated = F.lit(load_id or uuid.uuid4().hex)
    placed = observed.withColumn(LOAD, F.when(F.col("date").isNotNull(), F.lit("dated")).otherwise(undated))
    overwrite_dates(placed, path, by=("date", LOAD))
    return {key: int(value) for key, value in seen.get.items()}


def read_valid(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _read_status(spark, path, schema, VALID)


def read_rejected(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _read_status(spark, path, schema, REJECTED)


def _read_status(spark: SparkSession, path: str, schema: T.StructType, status: str) -> DataFrame:
    stored = T.StructType(list(schema.fields)).add("_dq_errors", T.ArrayType(T.StringType())).add(STATUS, T.StringType())
    rows = spark.read.schema(stored).parquet(path).where(F.col(STATUS) == status)
    return rows.drop(STATUS, "_dq_errors") if status == VALID else rows


def for_publishing(frame: DataFrame, table: str) -> DataFrame:
    """The published column list with date text turned into dates."""
    if table not in PUBLISHED_COLUMNS:
        raise ValueError(f"no published table is named {table!r}")
    columns = PUBLISHED_COLUMNS[table]
    out = []
    for name in columns:
        is_text = isinstance(frame.schema[name].dataType, T.StringType)
        if is_text and (name == "date" or name.endswith("_date")):
            out.append(F.to_date(name).alias(name))
        else:
            out.append(F.col(name))
    return frame.select(*out)


def publish_files(frame: DataFrame, table: str, path: str) -> None:
    overwrite_all(for_publishing(frame, table), path)


def publish_jdbc(frame: DataFrame, table: str, url: str, target: str, properties: dict[str, str]) -> None:
    """Truncate and reload a serving table; rows go from executors straight to it."""
    if not all(re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", part) for part in target.split(".")):
        raise ValueError(f"not a table name: {target!r}")
    for_publishing(frame, table).write.mode("overwrite").option("truncate", True).jdbc(url, target, properties=properties)


def export_request_rows(raw: DataFrame, path: str) -> None:
    r"""Tab-separated request rows, ``\N`` for NULL, defaults for absent keys."""
    defaults = {f.name: f.default for f in LLM_REQUEST.fields if f.has_default}
    have = set(raw.columns)
    out = []
    for name in EXPORT_COLUMNS:
        if name in have:
            out.append(F.col(name).cast("string").alias(name))
        else:
            value = defaults.get(name)
            if isinstance(value, bool):
                value = str(value).lower()
            out.append(F.lit(None if value is None else str(value)).cast("string").alias(name))
    rows = raw.select(*out)
    options = {"sep": "\t", "nullValue": "\\N", "emptyValue": "", "escape": '"', "quote": '"'}
    rows.write.mode("overwrite").options(**options).csv(path)


_LEDGER = (
    "pipeline_name string, layer string, start_time string, end_time string, duration_ms bigint, input_rows bigint, "
    "output_rows bigint, quarantine_rows bigint, status string"
)


def record_run(
    spark: SparkSession,
    path: str,
    pipeline_name: str,
    layer: str,
    start_time: datetime,
    end_time: datetime,
    input_rows: int,
    output_rows: int,
    quarantine_rows: int = 0,
    status: str = "success",
) -> None:
    """Append one line to the run ledger."""
    span = int((end_time - start_time).total_seconds() * 1000)
    stamps = [t.astimezone(timezone.utc).isoformat() for t in (start_time, end_time)]
    row = (pipeline_name, layer, *stamps, span, input_rows, output_rows, quarantine_rows, status)
    spark.createDataFrame([row], _LEDGER).write.mode("append").json(path)
