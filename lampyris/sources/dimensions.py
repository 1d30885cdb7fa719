"""Static dimension snapshots as DataFrames.

The rows are fixed reference values (prices, budgets, release dates); marts
compare against exactly these.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

# name, input USD per 1M tokens, output USD per 1M tokens, status
_MODELS = (
    ("deepseek-chat", 0.14, 0.28, "deprecated"),
    ("deepseek-reasoner", 0.14, 0.28, "deprecated"),
    ("deepseek-v4-flash", 0.14, 0.28, "active"),
    ("deepseek-v4-pro", 0.435, 0.87, "active"),
)
_MODEL_VERSIONS = (
    ("deepseek-chat", "v3-compat", "deprecated", "2026-01-01", "2026-04-24", False),
    ("deepseek-reasoner", "v3-compat", "deprecated", "2026-01-01", "2026-04-24", False),
    ("deepseek-v4-flash", "v4-flash-20260424", "active", "2026-04-24", "2026-06-01", True),
    ("deepseek-v4-pro", "v4-pro-20260424", "canary", "2026-05-15", "2026-06-10", False),
)
_PROMPT_VERSIONS = (
    ("prompt_001", "v1", "Support Chat Baseline", "team_support", "deprecated", "2026-01-01", "control",
     "Initial support assistant prompt."),
    ("prompt_001", "v2", "Support Chat Grounded", "team_support", "active", "2026-02-15", "treatment",
     "Adds retrieval-grounding and escalation instructions."),
    ("prompt_002", "v1", "Summary Baseline", "team_platform", "active", "2026-01-20", "control",
     "General summarization prompt for internal workflows."),
)
_TEAMS = (
    ("team_support", "Customer Support AI", "Customer Success", "CC-1100", 1200.0, "support_ai_manager"),
    ("team_sales", "Sales Productivity", "Revenue", "CC-2200", 900.0, "sales_ops_manager"),
    ("team_platform", "Internal Platform", "Engineering", "CC-3300", 1800.0, "platform_manager"),
)
_USERS = (
    ("user_0001", "team_support", "support_agent", "power"),
    ("user_0002", "team_support", "support_agent", "basic"),
    ("user_0003", "team_sales", "account_executive", "power"),
    ("user_0004", "team_sales", "sales_ops", "admin"),
    ("user_0005", "team_platform", "engineer", "admin"),
    ("user_0006", "team_platform", "product_manager", "power"),
)
# scope, match column, match value, bound columns
_SLA_RULES = (
    {"scope": "feature", "feature_name": "chat", "p95_latency_ms_max": 3000.0, "error_rate_max": 0.05},
    {"scope": "feature", "feature_name": "rag_answer", "p95_latency_ms_max": 5000.0, "error_rate_max": 0.03},
    {"scope": "retrieval", "knowledge_base_name": "product_docs", "p95_total_latency_ms_max": 2000.0,
     "zero_result_rate_max": 0.10},
    {"scope": "feedback", "app_name": "ai_support_bot", "satisfaction_rate_min": 0.80, "regeneration_rate_max": 0.15},
    {"scope": "guardrail", "rule_category": "pii_detection", "trigger_rate_max": 0.20, "p95_latency_ms_max": 300.0},
)
# component -> metric -> upper bound
_PLATFORM_THRESHOLDS = {
    "kafka": {"consumer_lag": 10000, "topic_size_bytes": 10000000000},
    "flink": {"checkpoint_duration_ms": 30000, "restart_count": 3, "backpressure_ratio": 0.8},
    "paimon": {"snapshot_count": 100, "file_count": 10000, "table_size_bytes": 500000000000},
    "doris": {"query_p95_ms": 3000, "compaction_lag_seconds": 600, "tablet_count": 10000},
}


def model_dimension(spark: SparkSession) -> DataFrame:
    released = date(2026, 4, 24)
    rows = [(name, "deepseek", i, o, 1_000_000, released, status) for name, i, o, status in _MODELS]
    return spark.createDataFrame(
        rows,
        "model_name string, provider string, input_price_per_1m_tokens double, output_price_per_1m_tokens double, "
        "max_context_tokens int, release_date date, status string",
    )


def model_version_dimension(spark: SparkSession) -> DataFrame:
    midnight = "T00:00:00+00:00"
    rows = [
        (model, version, "deepseek", status, first + midnight, last + midnight, current)
        for model, version, status, first, last, current in _MODEL_VERSIONS
    ]
    return spark.createDataFrame(
        rows,
        "model_name string, model_version string, provider string, deployment_status string, "
        "first_deployed_at string, last_deployed_at string, is_current_prod boolean",
    )


def prompt_version_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(_PROMPT_VERSIONS),
        "prompt_id string, prompt_version string, prompt_name string, owner_team_id string, status string, "
        "release_date string, ab_test_group string, description string",
    )


def team_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(*row, "active") for row in _TEAMS],
        "team_id string, team_name string, department string, cost_center string, budget_monthly_usd double, "
        "manager string, status string",
    )


def user_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(user, user, team, role, tier, "active") for user, team, role, tier in _USERS],
        "user_id string, user_name string, team_id string, role string, ai_access_tier string, status string",
    )


def sla_rules(spark: SparkSession) -> DataFrame:
    schema = (
        "scope string, feature_name string, knowledge_base_name string, app_name string, rule_category string, "
        "p95_latency_ms_max double, error_rate_max double, p95_total_latency_ms_max double, "
        "zero_result_rate_max double, satisfaction_rate_min double, regeneration_rate_max double, "
        "trigger_rate_max double"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    return spark.createDataFrame([tuple(rule.get(n) for n in names) for rule in _SLA_RULES], schema)


def platform_thresholds(spark: SparkSession) -> DataFrame:
    rows = [(c, m, float(v)) for c, metrics in _PLATFORM_THRESHOLDS.items() for m, v in metrics.items()]
    return spark.createDataFrame(rows, "component string, metric_name string, threshold double")
