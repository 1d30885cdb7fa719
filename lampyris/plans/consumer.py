"""Dashboard, KPI, metric and verification queries.

Reports sort as their consumers expect; sorting is the last step and runs on
summary-sized data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lampyris.functions.numeric import cost_units, exact_ratio, safe_divide, usd
from lampyris.operators.rollup import Percentile, Rollup, rows

col = F.col


def _cost() -> Column:
    return usd(F.sum(cost_units(col("estimated_cost_usd"))))


def _latency() -> Column:
    """Request-weighted mean of daily mean latencies, two digits."""
    weighted = F.sum(col("avg_latency_ms").cast("decimal(20,2)") * col("request_count"))
    return exact_ratio(weighted, F.sum("request_count"), 2)


# -- dashboards on the feature summary --------------------------------------


def daily_overview(feature_daily: DataFrame) -> DataFrame:
    """Traffic, reliability, tokens and cost per day."""
    daily = feature_daily.groupBy("date").agg(
        *[F.sum(c).alias(c) for c in ("request_count", "success_count", "error_count", "total_tokens")],
        _cost().alias("estimated_cost_usd"),
    )
    return daily.select(
        "date", "request_count", "success_count", "error_count",
        safe_divide(col("success_count"), col("request_count"), 4).alias("success_rate"),
        safe_divide(col("error_count"), col("request_count"), 4).alias("error_rate"),
        "total_tokens", "estimated_cost_usd",
    ).orderBy("date")


def requests_by_feature(feature_daily: DataFrame) -> DataFrame:
    out = feature_daily.groupBy("feature_name").agg(F.sum("request_count").alias("request_count"))
    return out.orderBy(col("request_count").desc(), "feature_name")


def cost_by_feature(feature_daily: DataFrame) -> DataFrame:
    out = feature_daily.groupBy("feature_name").agg(_cost().alias("estimated_cost_usd"))
    return out.orderBy(col("estimated_cost_usd").desc(), "feature_name")


def reliability_by_feature(feature_daily: DataFrame) -> DataFrame:
    counts = ("request_count", "success_count", "error_count")
    out = feature_daily.groupBy("feature_name").agg(*[F.sum(c).alias(c) for c in counts])
    return out.select(
        "feature_name", *counts,
        safe_divide(col("success_count"), col("request_count"), 4).alias("success_rate"),
        safe_divide(col("error_count"), col("request_count"), 4).alias("error_rate"),
    ).orderBy(col("error_rate").desc(), col("request_count").desc())


def latency_by_feature(feature_daily: DataFrame) -> DataFrame:
    out = feature_daily.groupBy("feature_name").agg(_latency().alias("weighted_avg_latency_ms"))
    return out.orderBy(col("weighted_avg_latency_ms").desc())


def cost_by_model(feature_daily: DataFrame) -> DataFrame:
    out = feature_daily.groupBy("model_name").agg(
        F.sum("request_count").alias("request_count"),
        F.sum("total_tokens").alias("total_tokens"),
        _cost().alias("estimated_cost_usd"),
    )
    per_request = exact_ratio(col("estimated_cost_usd"), col("request_count"), 8)
    return out.withColumn("avg_cost_per_request", per_request).orderBy(col("estimated_cost_usd").desc())


def leaderboard(feature_daily: DataFrame) -> DataFrame:
    out = feature_daily.groupBy("app_name", "feature_name").agg(
        F.sum("request_count").alias("request_count"),
        F.sum("error_count").alias("_errors"),
        _cost().alias("estimated_cost_usd"),
        _latency().alias("weighted_avg_latency_ms"),
    )
    return out.select(
        "app_name", "feature_name", "request_count", "estimated_cost_usd", "weighted_avg_latency_ms",
        safe_divide(col("_errors"), col("request_count"), 4).alias("error_rate"),
    ).orderBy(col("request_count").desc(), "app_name", "feature_name")


def cost_by_priced_model(feature_daily: DataFrame, models: DataFrame) -> DataFrame:
    """Model totals with list prices; models without a dimension row are left out.

    The join runs after the aggregation: one row per model on either side.
    """
    totals = feature_daily.groupBy("model_name").agg(
        F.sum("request_count").alias("request_count"),
        F.sum("total_tokens").alias("total_tokens"),
        _cost().alias("estimated_cost_usd"),
    )
    prices = models.select("model_name", "provider", "input_price_per_1m_tokens", "output_price_per_1m_tokens")
    return prices.join(totals, "model_name").orderBy(col("estimated_cost_usd").desc())


def daily_summary(feature_daily: DataFrame) -> DataFrame:
    return feature_daily.groupBy("date").agg(
        *[F.sum(c).alias(c) for c in ("request_count", "success_count", "error_count", "total_tokens")],
        _cost().alias("estimated_cost_usd"),
    )


# -- compliance, hand-offs, platform ----------------------------------------


def denied_access(audits: DataFrame) -> DataFrame:
    out = audits.where(~col("access_granted")).groupBy("date", "data_classification", "action_type", "denial_reason")
    return out.agg(
        F.count(F.lit(1)).alias("denied_access_cnt_1d"), F.count_distinct("user_id").alias("denied_user_cnt_1d")
    ).orderBy(col("date").desc(), col("denied_access_cnt_1d").desc())


def retention_evidence(actions: DataFrame) -> DataFrame:
    out = actions.groupBy("date", "policy_name", "table_name", "action_type").agg(
        F.count(F.lit(1)).alias("retention_action_cnt_1d"), F.sum("rows_affected").alias("rows_affected_cnt_1d")
    )
    return out.orderBy(col("date").desc(), col("rows_affected_cnt_1d").desc())


def handoff_bottlenecks(handoff_daily: DataFrame) -> DataFrame:
    return handoff_daily.select(
        "date", "parent_agent_id", "child_agent_id", "handoff_type", "handoff_cnt_1d", "error_cnt_1d",
        "timeout_cnt_1d", "avg_handoff_latency_ms", "p95_handoff_latency_ms",
    ).orderBy(col("date").desc(), col("p95_handoff_latency_ms").desc(), col("timeout_cnt_1d").desc())


def _utilization() -> Column:
    return safe_divide(col("metric_value"), col("threshold"))


def threshold_breaches(platform_daily: DataFrame) -> DataFrame:
    return (
        platform_daily.where("is_breach")
        .select(
            "date", "component", "metric_name", "metric_value", "threshold",
            F.round(_utilization(), 4).alias("threshold_utilization"),
        )
        .orderBy(col("date").desc(), col("threshold_utilization").desc())
    )


def regression_report(comparison: DataFrame) -> DataFrame:
    """Experiment comparison with regressions first."""
    sides = [
        f"{role}_{part}"
        for part in (
            "evaluation_count", "pass_count", "fail_count", "pass_rate", "avg_score", "avg_latency_ms",
            "avg_estimated_cost_usd",
        )
        for role in ("baseline", "candidate")
    ]
    flags = ("is_quality_regression", "is_cost_increase", "is_latency_increase")
    return comparison.select(
        "dataset_name", "experiment_name", "baseline_variant", "candidate_variant", "baseline_model_name",
        "baseline_prompt_version", "candidate_model_name", "candidate_prompt_version", "evaluation_dimension",
        "experiment_start_date", "experiment_end_date", *sides, "score_delta", "pass_rate_delta",
        "cost_increase_rate", "latency_increase_rate", *flags,
    ).orderBy(*[col(f).desc() for f in flags], "dataset_name", "experiment_name", "evaluation_dimension")


# -- single values and small panels -----------------------------------------


def kpi_total_requests(feature_daily: DataFrame) -> DataFrame:
    return feature_daily.agg(F.sum("request_count").alias("value"))


def kpi_success_rate(feature_daily: DataFrame) -> DataFrame:
    return feature_daily.agg(safe_divide(F.sum("success_count"), F.sum("request_count"), 4).alias("value"))


def kpi_total_cost(feature_daily: DataFrame) -> DataFrame:
    return feature_daily.agg(_cost().alias("value"))


def kpi_average_latency(feature_daily: DataFrame) -> DataFrame:
    return feature_daily.agg(_latency().alias("value"))


def daily_trend(feature_daily: DataFrame) -> DataFrame:
    out = feature_daily.groupBy(col("date").alias("time")).agg(
        F.sum("request_count").alias("request_count"),
        _cost().alias("estimated_cost_usd"),
        safe_divide(F.sum("error_count"), F.sum("request_count"), 4).alias("error_rate"),
    )
    return out.orderBy("time")


def feature_breakdown(feature_daily: DataFrame) -> DataFrame:
    out = feature_daily.groupBy("feature_name").agg(
        F.sum("request_count").alias("request_count"),
        safe_divide(F.sum("error_count"), F.sum("request_count"), 4).alias("error_rate"),
        _latency().alias("weighted_avg_latency_ms"),
    )
    return out.orderBy(col("request_count").desc())


def kpi_handoffs(handoff_daily: DataFrame, column: str = "handoff_cnt_1d") -> DataFrame:
    return handoff_daily.agg(F.sum(column).alias("value"))


def kpi_handoff_p95(handoff_daily: DataFrame) -> DataFrame:
    return handoff_daily.agg(F.max("p95_handoff_latency_ms").alias("value"))


def daily_handoffs(handoff_daily: DataFrame) -> DataFrame:
    counts = ("handoff_cnt_1d", "error_cnt_1d", "timeout_cnt_1d")
    return handoff_daily.groupBy(col("date").alias("time")).agg(*[F.sum(c).alias(c) for c in counts]).orderBy("time")


def kpi_denied_attempts(audits: DataFrame) -> DataFrame:
    return audits.where(~col("access_granted")).agg(F.count(F.lit(1)).alias("value"))


def kpi_denied_users(audits: DataFrame) -> DataFrame:
    return audits.where(~col("access_granted")).agg(F.count_distinct("user_id").alias("value"))


def kpi_retention_actions(actions: DataFrame) -> DataFrame:
    return actions.agg(F.count(F.lit(1)).alias("value"))


def kpi_retention_rows(actions: DataFrame) -> DataFrame:
    return actions.agg(F.sum("rows_affected").alias("value"))


def kpi_breaches(platform_daily: DataFrame) -> DataFrame:
    return platform_daily.agg(F.count_if(col("is_breach")).alias("value"))


def kpi_healthy_ratio(platform_daily: DataFrame) -> DataFrame:
    return platform_daily.agg(safe_divide(F.count_if(~col("is_breach")), F.count(F.lit(1))).alias("value"))


def kpi_max_utilization(platform_daily: DataFrame) -> DataFrame:
    return platform_daily.agg(F.round(F.max(_utilization()), 4).alias("value"))


def kpi_tracked_components(platform_daily: DataFrame) -> DataFrame:
    return platform_daily.agg(F.count_distinct("component").alias("value"))


def component_status(platform_daily: DataFrame) -> DataFrame:
    out = platform_daily.groupBy("component").agg(
        F.count_if(col("is_breach")).alias("breach_metric_cnt"),
        F.round(F.max(_utilization()), 4).alias("max_threshold_utilization"),
    )
    return out.orderBy(col("max_threshold_utilization").desc())


def utilization_trend(platform_daily: DataFrame) -> DataFrame:
    out = platform_daily.groupBy(col("date").alias("time"), col("component").alias("metric")).agg(
        F.round(F.max(_utilization()), 4).alias("value")
    )
    return out.orderBy("time", "metric")


# -- metrics on the request fact ---------------------------------------------


def request_count(requests: DataFrame) -> DataFrame:
    return requests.agg(F.count(F.lit(1)).alias("total_requests"))


def status_rate(requests: DataFrame, status: str) -> DataFrame:
    share = safe_divide(F.count_if(col("status") == status), F.count(F.lit(1)))
    return requests.agg(share.alias(f"{status}_rate"))


def token_total(requests: DataFrame, column: str = "total_tokens") -> DataFrame:
    return requests.agg(F.sum(column).alias(column))


def cost_total(requests: DataFrame) -> DataFrame:
    return requests.agg(_cost().alias("total_estimated_cost_usd"))


def success_latency_mean(requests: DataFrame) -> DataFrame:
    return requests.where("status = 'success'").agg(F.avg("latency_ms").alias("avg_latency_ms"))


def success_latency_p95(requests: DataFrame) -> DataFrame:
    """One global percentile: the histogram step spreads the rows by value."""
    whole = Rollup(("_all",), (rows("_n"),), Percentile("p95_latency_ms", "latency_ms", 95))
    succeeded = requests.where("status = 'success'").withColumn("_all", F.lit(1))
    return whole.build(succeeded).select("p95_latency_ms")


def model_cost(requests: DataFrame) -> DataFrame:
    out = requests.groupBy("model_name").agg(_cost().alias("total_cost_usd"))
    return out.orderBy(col("total_cost_usd").desc())


def model_error_rate(requests: DataFrame) -> DataFrame:
    out = requests.groupBy("model_name").agg(
        F.count_if(col("status") == "error").alias("error_count"), F.count(F.lit(1)).alias("total_count")
    )
    rate = safe_divide(col("error_count"), col("total_count")).alias("error_rate")
    return out.select("*", rate).orderBy(col("error_rate").desc())


def feature_tokens(requests: DataFrame) -> DataFrame:
    out = requests.groupBy("feature_name").agg(
        F.sum("prompt_tokens").alias("input_tokens"),
        F.sum("completion_tokens").alias("output_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
    )
    return out.orderBy(col("total_tokens").desc())


# -- metrics on marts and summaries ------------------------------------------


def prompt_version_rates(prompt_metrics: DataFrame) -> DataFrame:
    def share(num: str, den: str) -> Column:
        return safe_divide(F.sum(num), F.sum(den))

    score = F.sum(col("evaluation_score_numerator").cast("decimal(28,12)")).cast("double")
    return prompt_metrics.groupBy("prompt_id", "prompt_version", "model_name").agg(
        share("success_count", "request_count").alias("success_rate"),
        share("error_count", "request_count").alias("error_rate"),
        share("pass_count", "evaluation_count").alias("pass_rate"),
        safe_divide(score, F.sum("evaluation_score_denominator")).alias("avg_evaluation_score"),
    )


def unhealthy_traces(trace_health: DataFrame) -> DataFrame:
    return (
        trace_health.where("is_high_cost_trace or is_slow_trace or is_failed_trace")
        .select(
            "date", "trace_id", "bottleneck_node_type", "bottleneck_node_id", "trace_latency_ms", "trace_cost_usd",
            "trace_status", "child_observation_summary",
        )
        .orderBy(col("date").desc(), col("trace_cost_usd").desc(), col("trace_latency_ms").desc())
    )


def tool_failure_rate(tool_daily: DataFrame) -> DataFrame:
    out = tool_daily.groupBy("tool_name").agg(
        F.sum("error_count").alias("failed_calls"), F.sum("tool_call_count").alias("total_calls")
    )
    rate = safe_divide(col("failed_calls"), col("total_calls")).alias("failure_rate")
    return out.select("*", rate).orderBy(col("failure_rate").desc())


# -- verification -------------------------------------------------------------


def fact_row_counts(facts: dict[str, DataFrame]) -> DataFrame:
    """Rows per fact table."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for name, df in facts.items()]
    return reduce(DataFrame.unionByName, parts)


def summary_control_totals(summaries: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Rows and a control total per summary table."""
    parts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.sum(control.cast("bigint")).alias("control_total"),
        )
        for name, (df, control) in summaries.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def reconciliation(validated: DataFrame, summary: DataFrame, control: str) -> DataFrame:
    """Source rows against valid + rejected rows and against the summary total."""
    counts = validated.agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(col("_dq_status") == "valid").alias("valid_rows"),
        F.count_if(col("_dq_status") == "quarantine").alias("quarantine_rows"),
        F.lit(0).cast("bigint").alias("summary_total"),
    )
    totals = summary.agg(
        F.lit(0).cast("bigint").alias("source_rows"),
        F.lit(0).cast("bigint").alias("valid_rows"),
        F.lit(0).cast("bigint").alias("quarantine_rows"),
        F.sum(control).alias("summary_total"),
    )
    both = counts.unionByName(totals).agg(
        *[F.sum(c).alias(c) for c in ("source_rows", "valid_rows", "quarantine_rows", "summary_total")]
    )
    split_ok = col("source_rows") == col("valid_rows") + col("quarantine_rows")
    return both.select(
        "*", split_ok.alias("split_balances"), (col("summary_total") == col("valid_rows")).alias("summary_balances")
    )
