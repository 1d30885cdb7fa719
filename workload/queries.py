"""Registered queries: a Spark plan and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lampyris.contracts import CONTRACTS
from lampyris.operators import quality
from lampyris.plans import consumer, facts, marts, summaries, trace_health
from workload import views
from workload.fact_oracles import COLUMNS, RULES
from workload.oracles import big, rounded, units, up, usd_sum, with_ctes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, query: Query, oracle: str | None = None) -> None:
    QUERIES[name] = query
    if oracle is not None:
        ORACLES[name] = with_ctes(oracle)


class Data:
    """Typed, valid facts and summaries of one test directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return views.view(self.spark, self.sf_dir, name)

    def fact(self, name: str) -> DataFrame:
        return facts.valid(self.raw(name), name)

    def feature_daily(self) -> DataFrame:
        return summaries.feature_daily(self.fact("llm_request"))

    def feature_hourly(self) -> DataFrame:
        return summaries.feature_hourly(self.fact("llm_request"))

    def agent_daily(self) -> DataFrame:
        return summaries.agent_daily(self.fact("agent_run"), self.fact("agent_span"))

    def agent_team_daily(self) -> DataFrame:
        return summaries.agent_team_daily(self.fact("agent_run"), self.fact("agent_span"), self.raw("user_dim"))

    def session_daily(self) -> DataFrame:
        return summaries.session_daily(self.fact("llm_request"), self.fact("feedback"))

    def prompt_daily(self) -> DataFrame:
        return summaries.prompt_version_daily(self.fact("llm_request"), self.fact("evaluation"))

    def team_cost_daily(self) -> DataFrame:
        return summaries.team_cost_daily(self.fact("llm_request"), self.raw("user_dim"), self.fact("agent_run"))

    def handoff_daily(self) -> DataFrame:
        return summaries.handoff_daily(self.fact("handoff"))

    def platform_daily(self) -> DataFrame:
        return summaries.platform_health_daily(self.fact("platform_health"))

    def tool_daily(self) -> DataFrame:
        return summaries.tool_daily(self.fact("tool_call"))

    def retrieval_daily(self) -> DataFrame:
        return summaries.retrieval_daily(self.fact("retrieval"))

    def feedback_daily(self) -> DataFrame:
        return summaries.feedback_daily(self.fact("feedback"))

    def guardrail_daily(self) -> DataFrame:
        return summaries.guardrail_daily(self.fact("guardrail"))

    def evaluation_daily(self) -> DataFrame:
        return summaries.evaluation_daily(self.fact("evaluation"))

    def trace_health(self) -> DataFrame:
        kinds = ("llm_request", "agent_run", "agent_span", "tool_call", "retrieval")
        return trace_health.trace_health(*[facts.valid(views.shared(self.spark, self.sf_dir, k, by_trace=True), k) for k in kinds])

    def regression(self) -> DataFrame:
        return marts.experiment_regression(
            self.fact("evaluation"), self.fact("llm_request"), self.raw("experiment_assignment"),
            self.raw("experiment_comparison"),
        )


class Shared(Data):
    """For queries of many facts: these read the same shuffles."""

    def raw(self, name: str) -> DataFrame:
        return views.shared(self.spark, self.sf_dir, name)


def _on(build: Callable[[Data], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Data(spark, sf_dir))


# --- facts, rejects, status counts ------------------------------------------

for _name in views.FACTS:
    register(f"fact_{_name}", _on(lambda d, n=_name: d.fact(n)), f"select {COLUMNS[_name]} from f_{_name}")


def _rejects(d: Data, name: str) -> DataFrame:
    checked = facts.validated(d.raw(name), name)
    rejected = quality.split(checked)[1]
    return rejected.select(CONTRACTS[name].key, "date", F.array_join("_dq_errors", ",").alias("errors"))


def _labels_sql(name: str) -> str:
    marks = ", ".join(f"case when not ({rule}) then '{label}' end" for label, rule in RULES[name])
    return f"concat_ws(',', {marks})"


_RULED = list(RULES)
for _name in _RULED:
    register(
        f"rejected_{_name}",
        _on(lambda d, n=_name: _rejects(d, n)),
        f"select * from (select {CONTRACTS[_name].key}, date, {_labels_sql(_name)} as errors from v_{_name}) t where errors <> ''",
    )


def _status_counts(d: Data) -> DataFrame:
    out = None
    for name in _RULED:
        part = quality.status_counts(facts.validated(d.raw(name), name)).withColumn("table_name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


register(
    "quality_status_counts",
    _on(_status_counts),
    " union all ".join(
        f"select '{n}' as table_name, case when {_labels_sql(n)} = '' then 'valid' else 'quarantine' end as _dq_status, "
        f"count(*) as row_count from v_{n} group by all"
        for n in _RULED
    ),
)


def _stream_validity(d: Data) -> DataFrame:
    """Streaming convention: NULLs take defaults and a NULL rule rejects the row."""
    out = None
    for name in _RULED:
        kept = facts.valid(d.raw(name), name, fill_nulls=True, null_fails=True)
        part = kept.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        out = part if out is None else out.unionByName(part)
    return out


register(
    "quality_stream_filter",
    _on(_stream_validity),
    " union all ".join(
        f"select '{n}' as table_name, count(*) as row_count from v_{n} where "
        + " and ".join(f"({rule})" for _, rule in RULES[n])
        for n in _RULED
    ),
)
register(
    "quality_status_request",
    _on(lambda d: quality.status_counts(facts.validated(d.raw("llm_request"), "llm_request"))),
    f"select case when {_labels_sql('llm_request')} = '' then 'valid' else 'quarantine' end as _dq_status, "
    "count(*) as row_count from v_llm_request group by all",
)
register(
    "request_cost_estimate",
    _on(
        lambda d: facts.with_estimated_cost(d.fact("llm_request").drop("estimated_cost_usd"), d.raw("model_dim")).select(
            "request_id", "created_at", "model_name", "prompt_tokens", "completion_tokens", "estimated_cost_usd"
        )
    ),
    """select request_id, created_at, r.model_name, prompt_tokens, completion_tokens,
      round(prompt_tokens / 1000000 * coalesce(input_price_per_1m_tokens, 0.14)
        + completion_tokens / 1000000 * coalesce(output_price_per_1m_tokens, 0.28), 8) as estimated_cost_usd
    from f_llm_request r left join v_model_dim m on r.model_name = m.model_name""",
)
register(
    "text_privacy_columns",
    lambda spark, sf_dir: _privacy(spark, sf_dir),
    "select doc_id, sha256(text) as text_hash, cast(length(text) as integer) as text_chars, sha256(concat('salt:', source)) as source_hash "
    "from documents",
)


def _privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lampyris.functions.text import hashed_ip, text_hash

    return views.table(spark, sf_dir, "documents").select(
        "doc_id", text_hash(F.col("text")).alias("text_hash"), F.length("text").alias("text_chars"),
        hashed_ip(F.col("source"), "salt").alias("source_hash"),
    )


register(
    "dimension_knowledge_base",
    _on(lambda d: facts.knowledge_base_dimension(d.fact("retrieval"))),
    "select knowledge_base_id, arg_max(knowledge_base_name, (created_at, knowledge_base_name)) as knowledge_base_name, "
    "'unknown' as knowledge_base_type, cast(0 as bigint) as document_count, '' as owner_team, "
    "max(created_at) as last_updated_at, 'active' as status from f_retrieval group by all",
)
register(
    "dimension_guardrail_rule",
    _on(lambda d: facts.guardrail_rule_dimension(d.fact("guardrail"))),
    "select rule_name, arg_max(rule_category, (created_at, rule_category, severity)) as rule_category, "
    "arg_max(severity, (created_at, rule_category, severity)) as default_severity, '' as owner_team, "
    "cast(null as varchar) as description, 'active' as status from f_guardrail group by all",
)

# --- summaries ----------------------------------------------------------------

_SUMMARIES: dict[str, tuple[Callable[[Data], DataFrame], str]] = {
    "summary_feature_daily": (Data.feature_daily, "w_feature_daily"),
    "summary_feature_hourly": (Data.feature_hourly, "w_feature_hourly"),
    "summary_session_daily": (Data.session_daily, "w_session_daily"),
    "summary_feature_env_daily": (lambda d: summaries.feature_env_daily(d.fact("llm_request")), "w_feature_env_daily"),
    "summary_region_daily": (lambda d: summaries.region_daily(d.fact("llm_request")), "w_region_daily"),
    "summary_agent_daily": (Data.agent_daily, "w_agent_daily"),
    "summary_agent_team_daily": (Data.agent_team_daily, "w_agent_team_daily"),
    "summary_tool_daily": (Data.tool_daily, "w_tool_daily"),
    "summary_handoff_daily": (Data.handoff_daily, "w_handoff_daily"),
    "summary_retrieval_daily": (Data.retrieval_daily, "w_retrieval_daily"),
    "summary_feedback_daily": (Data.feedback_daily, "w_feedback_daily"),
    "summary_guardrail_daily": (Data.guardrail_daily, "w_guardrail_daily"),
    "summary_evaluation_daily": (Data.evaluation_daily, "w_evaluation_daily"),
    "summary_team_cost_daily": (Data.team_cost_daily, "w_team_cost_daily"),
    "summary_prompt_version_daily": (Data.prompt_daily, "w_prompt_daily"),
    "summary_platform_health_daily": (Data.platform_daily, "w_platform_daily"),
    "summary_feature_daily_from_hourly": (
        lambda d: summaries.feature_daily_from_hourly(d.feature_hourly()), "w_feature_daily_from_hourly",
    ),
}
for _name, (_build, _table) in _SUMMARIES.items():
    register(_name, _on(_build), f"select * from {_table}")

# --- marts --------------------------------------------------------------------

_MARTS: dict[str, tuple[Callable[[Data], DataFrame], str]] = {
    "mart_cost_anomalies": (lambda d: marts.cost_anomalies(d.feature_daily()), "m_cost_anomalies"),
    "mart_sla_report": (lambda d: marts.sla_report(d.feature_daily(), d.raw("sla_rule")), "m_sla_report"),
    "mart_prompt_version_metrics": (lambda d: marts.prompt_version_metrics(d.prompt_daily()), "m_prompt_metrics"),
    "mart_prompt_version_comparison": (lambda d: marts.prompt_version_comparison(d.prompt_daily()), "m_prompt_comparison"),
    "mart_prompt_version_comparison_by_version": (
        lambda d: marts.prompt_version_comparison(d.prompt_daily(), ("prompt_version",)), "m_prompt_comparison_by_version",
    ),
    "mart_retrieval_quality": (lambda d: marts.retrieval_quality(d.retrieval_daily()), "m_retrieval_quality"),
    "mart_satisfaction": (lambda d: marts.satisfaction(d.feedback_daily(), d.feature_daily()), "m_satisfaction"),
    "mart_guardrail_violations": (lambda d: marts.guardrail_violations(d.guardrail_daily()), "m_guardrail_violations"),
    "mart_daily_budget": (lambda d: marts.daily_budget(d.team_cost_daily(), d.raw("team_dim")), "m_daily_budget"),
    "mart_daily_budget_copies": (
        lambda d: marts.daily_budget(d.team_cost_daily(), d.raw("team_dim"), agent_cost_per_model=True), "m_daily_budget_copies",
    ),
    "mart_monthly_chargeback": (
        lambda d: marts.monthly_chargeback(d.team_cost_daily(), d.raw("team_dim")), "m_monthly_chargeback",
    ),
    "mart_weekly_summary": (
        lambda d: marts.weekly_summary(
            d.feature_daily(), d.agent_daily(), d.retrieval_daily(), d.feedback_daily(), d.guardrail_daily(),
            d.evaluation_daily(),
        ),
        "m_weekly_summary",
    ),
    "mart_trace_health": (Data.trace_health, "m_trace_health"),
    "mart_experiment_regression": (Data.regression, "m_regression"),
    "mart_experiment_comparison": (lambda d: marts.experiment_comparison(d.regression()), "m_comparison"),
}
for _name, (_build, _table) in _MARTS.items():
    register(_name, _on(_build), f"select * from {_table}")

# --- dashboards and KPIs --------------------------------------------------------

_COUNTS = ", ".join(f"{big(f'sum({c})')} as {c}" for c in ("request_count", "success_count", "error_count", "total_tokens"))
_WEIGHTED = (
    "round(sum(cast(round(avg_latency_ms * 100) as hugeint) * request_count), 0)",
    "100 * sum(request_count)",
)


def _weighted_latency() -> str:
    return up(_WEIGHTED[0], _WEIGHTED[1], 2)


def _share(num: str, den: str, digits: int = 4) -> str:
    return up(num, den, digits)


def _feature(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _on(lambda d: build(d.feature_daily()))


register(
    "dash_daily_overview",
    _feature(consumer.daily_overview),
    f"select *, {_share('success_count', 'request_count')} as success_rate, {_share('error_count', 'request_count')} as error_rate "
    f"from (select date, {_COUNTS}, {usd_sum()} as estimated_cost_usd from w_feature_daily group by date) t",
)
register(
    "dash_requests_by_feature",
    _feature(consumer.requests_by_feature),
    f"select feature_name, {big('sum(request_count)')} as request_count from w_feature_daily group by 1",
)
register(
    "dash_cost_by_feature",
    _feature(consumer.cost_by_feature),
    f"select feature_name, {usd_sum()} as estimated_cost_usd from w_feature_daily group by 1",
)
register(
    "dash_denied_access",
    _on(lambda d: consumer.denied_access(d.fact("access_audit"))),
    "select date, data_classification, action_type, denial_reason, count(*) as denied_access_cnt_1d, "
    "count(distinct user_id) as denied_user_cnt_1d from f_access_audit where not access_granted group by all",
)
register(
    "dash_retention_evidence",
    _on(lambda d: consumer.retention_evidence(d.fact("data_retention"))),
    "select date, policy_name, table_name, action_type, count(*) as retention_action_cnt_1d, "
    f"{big('sum(rows_affected)')} as rows_affected_cnt_1d from f_data_retention group by all",
)
register(
    "dash_handoff_bottlenecks",
    _on(lambda d: consumer.handoff_bottlenecks(d.handoff_daily())),
    "select date, parent_agent_id, child_agent_id, handoff_type, handoff_cnt_1d, error_cnt_1d, timeout_cnt_1d, "
    "avg_handoff_latency_ms, p95_handoff_latency_ms from w_handoff_daily",
)
register(
    "dash_threshold_breaches",
    _on(lambda d: consumer.threshold_breaches(d.platform_daily())),
    "select date, component, metric_name, metric_value, threshold, "
    f"{rounded('(metric_value / nullif(threshold, 0))', 4)} as threshold_utilization from w_platform_daily where is_breach",
)
register(
    "dash_reliability_by_feature",
    _feature(consumer.reliability_by_feature),
    f"select feature_name, request_count, success_count, error_count, {_share('success_count', 'request_count')} as success_rate, "
    f"{_share('error_count', 'request_count')} as error_rate from (select feature_name, {_COUNTS} from w_feature_daily group by 1) t",
)
register(
    "dash_latency_by_feature",
    _feature(consumer.latency_by_feature),
    f"select feature_name, {_weighted_latency()} as weighted_avg_latency_ms from w_feature_daily group by 1",
)
register(
    "dash_cost_by_model",
    _feature(consumer.cost_by_model),
    f"select model_name, request_count, total_tokens, estimated_cost_usd, "
    f"{_share(units('estimated_cost_usd'), '1000000000000 * request_count', 8)} as avg_cost_per_request from ("
    f"select model_name, {_COUNTS}, {usd_sum()} as estimated_cost_usd from w_feature_daily group by 1) t",
)
register(
    "dash_leaderboard",
    _feature(consumer.leaderboard),
    f"select app_name, feature_name, {big('sum(request_count)')} as request_count, {usd_sum()} as estimated_cost_usd, "
    f"{_weighted_latency()} as weighted_avg_latency_ms, {_share('sum(error_count)', 'sum(request_count)')} as error_rate "
    "from w_feature_daily group by 1, 2",
)
register(
    "dash_cost_by_priced_model",
    _on(lambda d: consumer.cost_by_priced_model(d.feature_daily(), d.raw("model_dim"))),
    f"select t.model_name, provider, input_price_per_1m_tokens, output_price_per_1m_tokens, request_count, total_tokens, "
    f"estimated_cost_usd from v_model_dim m join (select model_name, {_COUNTS}, {usd_sum()} as estimated_cost_usd "
    "from w_feature_daily group by 1) t on m.model_name = t.model_name",
)
register(
    "dash_experiment_regression",
    _on(lambda d: consumer.regression_report(marts.experiment_comparison(d.regression()))),
    "select dataset_name, experiment_name, baseline_variant, candidate_variant, baseline_model_name, baseline_prompt_version, "
    "candidate_model_name, candidate_prompt_version, evaluation_dimension, experiment_start_date, experiment_end_date, "
    + ", ".join(
        f"{r}_{p}"
        for p in ("evaluation_count", "pass_count", "fail_count", "pass_rate", "avg_score", "avg_latency_ms", "avg_estimated_cost_usd")
        for r in ("baseline", "candidate")
    )
    + ", score_delta, pass_rate_delta, cost_increase_rate, latency_increase_rate, is_quality_regression, is_cost_increase, "
    "is_latency_increase from m_comparison",
)
register(
    "dash_daily_summary",
    _feature(consumer.daily_summary),
    f"select date, {_COUNTS}, {usd_sum()} as estimated_cost_usd from w_feature_daily group by date",
)
register(
    "dash_daily_trend",
    _feature(consumer.daily_trend),
    f"select date as time, {big('sum(request_count)')} as request_count, {usd_sum()} as estimated_cost_usd, "
    f"{_share('sum(error_count)', 'sum(request_count)')} as error_rate from w_feature_daily group by 1",
)
register("kpi_total_requests", _feature(consumer.kpi_total_requests), f"select {big('sum(request_count)')} as value from w_feature_daily")
register(
    "kpi_success_rate",
    _feature(consumer.kpi_success_rate),
    f"select {_share('sum(success_count)', 'sum(request_count)')} as value from w_feature_daily",
)
register("kpi_total_cost", _feature(consumer.kpi_total_cost), f"select {usd_sum()} as value from w_feature_daily")
register("kpi_average_latency", _feature(consumer.kpi_average_latency), f"select {_weighted_latency()} as value from w_feature_daily")
register(
    "kpi_feature_breakdown",
    _feature(consumer.feature_breakdown),
    f"select feature_name, {big('sum(request_count)')} as request_count, {_share('sum(error_count)', 'sum(request_count)')} as error_rate, "
    f"{_weighted_latency()} as weighted_avg_latency_ms from w_feature_daily group by 1",
)
for _kpi, _column in (("handoffs", "handoff_cnt_1d"), ("handoff_errors", "error_cnt_1d"), ("handoff_timeouts", "timeout_cnt_1d")):
    register(
        f"kpi_{_kpi}",
        _on(lambda d, c=_column: consumer.kpi_handoffs(d.handoff_daily(), c)),
        f"select {big(f'sum({_column})')} as value from w_handoff_daily",
    )
register(
    "kpi_handoff_p95",
    _on(lambda d: consumer.kpi_handoff_p95(d.handoff_daily())),
    "select max(p95_handoff_latency_ms) as value from w_handoff_daily",
)
register(
    "kpi_daily_handoffs",
    _on(lambda d: consumer.daily_handoffs(d.handoff_daily())),
    f"select date as time, {big('sum(handoff_cnt_1d)')} as handoff_cnt_1d, {big('sum(error_cnt_1d)')} as error_cnt_1d, "
    f"{big('sum(timeout_cnt_1d)')} as timeout_cnt_1d from w_handoff_daily group by 1",
)
register(
    "kpi_denied_attempts",
    _on(lambda d: consumer.kpi_denied_attempts(d.fact("access_audit"))),
    "select count(*) as value from f_access_audit where not access_granted",
)
register(
    "kpi_denied_users",
    _on(lambda d: consumer.kpi_denied_users(d.fact("access_audit"))),
    "select count(distinct user_id) as value from f_access_audit where not access_granted",
)
register(
    "kpi_retention_actions",
    _on(lambda d: consumer.kpi_retention_actions(d.fact("data_retention"))),
    "select count(*) as value from f_data_retention",
)
register(
    "kpi_retention_rows",
    _on(lambda d: consumer.kpi_retention_rows(d.fact("data_retention"))),
    f"select {big('sum(rows_affected)')} as value from f_data_retention",
)
register(
    "kpi_breaches",
    _on(lambda d: consumer.kpi_breaches(d.platform_daily())),
    "select count(*) filter (is_breach) as value from w_platform_daily",
)
register(
    "kpi_healthy_ratio",
    _on(lambda d: consumer.kpi_healthy_ratio(d.platform_daily())),
    "select count(*) filter (not is_breach) / count(*) as value from w_platform_daily",
)
register(
    "kpi_max_utilization",
    _on(lambda d: consumer.kpi_max_utilization(d.platform_daily())),
    f"select {rounded('max(metric_value / nullif(threshold, 0))', 4)} as value from w_platform_daily",
)
register(
    "kpi_tracked_components",
    _on(lambda d: consumer.kpi_tracked_components(d.platform_daily())),
    "select count(distinct component) as value from w_platform_daily",
)
register(
    "kpi_component_status",
    _on(lambda d: consumer.component_status(d.platform_daily())),
    "select component, count(*) filter (is_breach) as breach_metric_cnt, "
    f"{rounded('max(metric_value / nullif(threshold, 0))', 4)} as max_threshold_utilization from w_platform_daily group by 1",
)
register(
    "kpi_utilization_trend",
    _on(lambda d: consumer.utilization_trend(d.platform_daily())),
    f"select date as time, component as metric, {rounded('max(metric_value / nullif(threshold, 0))', 4)} as value "
    "from w_platform_daily group by 1, 2",
)

# --- metrics on facts -----------------------------------------------------------


def _requests(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _on(lambda d: build(d.fact("llm_request")))


register("metric_request_count", _requests(consumer.request_count), "select count(*) as total_requests from f_llm_request")
for _status in ("success", "error"):
    register(
        f"metric_{_status}_rate",
        _requests(lambda df, s=_status: consumer.status_rate(df, s)),
        f"select count(*) filter (status = '{_status}') / count(*) as {_status}_rate from f_llm_request",
    )
for _column in ("total_tokens", "prompt_tokens", "completion_tokens"):
    register(
        f"metric_{_column}",
        _requests(lambda df, c=_column: consumer.token_total(df, c)),
        f"select {big(f'sum({_column})')} as {_column} from f_llm_request",
    )
register("metric_cost_total", _requests(consumer.cost_total), f"select {usd_sum()} as total_estimated_cost_usd from f_llm_request")
register(
    "metric_success_latency_mean",
    _requests(consumer.success_latency_mean),
    "select sum(latency_ms)::double / count(latency_ms) as avg_latency_ms from f_llm_request where status = 'success'",
)
register(
    "metric_success_latency_p95",
    _requests(consumer.success_latency_p95),
    "select quantile_disc(latency_ms, 0.95) as p95_latency_ms from f_llm_request where status = 'success'",
)
register(
    "metric_model_cost",
    _requests(consumer.model_cost),
    f"select model_name, {usd_sum()} as total_cost_usd from f_llm_request group by 1",
)
register(
    "metric_model_error_rate",
    _requests(consumer.model_error_rate),
    "select model_name, count(*) filter (status = 'error') as error_count, count(*) as total_count, "
    "count(*) filter (status = 'error') / count(*) as error_rate from f_llm_request group by 1",
)
register(
    "metric_feature_tokens",
    _requests(consumer.feature_tokens),
    f"select feature_name, {big('sum(prompt_tokens)')} as input_tokens, {big('sum(completion_tokens)')} as output_tokens, "
    f"{big('sum(total_tokens)')} as total_tokens from f_llm_request group by 1",
)
register(
    "metric_prompt_version_rates",
    _on(lambda d: consumer.prompt_version_rates(marts.prompt_version_metrics(d.prompt_daily()))),
    "select prompt_id, prompt_version, model_name, sum(success_count)::double / nullif(sum(request_count), 0) as success_rate, "
    "sum(error_count)::double / nullif(sum(request_count), 0) as error_rate, "
    "sum(pass_count)::double / nullif(sum(evaluation_count), 0) as pass_rate, "
    "(sum(cast(round(evaluation_score_numerator * 100) as bigint))::double / 100) / nullif(sum(evaluation_score_denominator), 0) "
    "as avg_evaluation_score from m_prompt_metrics group by all",
)
register(
    "metric_unhealthy_traces",
    _on(lambda d: consumer.unhealthy_traces(d.trace_health())),
    "select date, trace_id, bottleneck_node_type, bottleneck_node_id, trace_latency_ms, trace_cost_usd, trace_status, "
    "child_observation_summary from m_trace_health where is_high_cost_trace or is_slow_trace or is_failed_trace",
)
register(
    "metric_tool_failure_rate",
    _on(lambda d: consumer.tool_failure_rate(d.tool_daily())),
    f"select tool_name, {big('sum(error_count)')} as failed_calls, {big('sum(tool_call_count)')} as total_calls, "
    "sum(error_count)::double / sum(tool_call_count) as failure_rate from w_tool_daily group by 1",
)

# --- verification -----------------------------------------------------------------

_COUNTED = (
    "llm_request retrieval feedback guardrail evaluation model_deployment access_audit data_retention handoff"
).split()
register(
    "verify_fact_counts",
    _on(lambda d: consumer.fact_row_counts({n: d.fact(n) for n in _COUNTED})),
    " union all ".join(f"select '{n}' as table_name, count(*) as row_count from f_{n}" for n in _COUNTED),
)
_CONTROLS: dict[str, tuple[Callable[[Data], DataFrame], str, str]] = {
    "feature_daily": (Data.feature_daily, "request_count", "w_feature_daily"),
    "retrieval_daily": (Data.retrieval_daily, "retrieval_cnt_1d", "w_retrieval_daily"),
    "feedback_daily": (lambda d: summaries.FEEDBACK_DAILY.totals(d.fact("feedback")), "feedback_cnt_1d", "w_feedback_daily"),
    "guardrail_daily": (lambda d: summaries.GUARDRAIL_DAILY.totals(d.fact("guardrail")), "check_cnt_1d", "w_guardrail_daily"),
    "team_cost_daily": (Data.team_cost_daily, "request_cnt_1d", "w_team_cost_daily"),
    "evaluation_daily": (lambda d: summaries.EVALUATION_DAILY.totals(d.fact("evaluation")), "evaluation_cnt_1d", "w_evaluation_daily"),
    "prompt_version_daily": (Data.prompt_daily, "request_cnt_1d", "w_prompt_daily"),
    "feature_env_daily": (lambda d: summaries.feature_env_daily(d.fact("llm_request")), "request_cnt_1d", "w_feature_env_daily"),
    "region_daily": (lambda d: summaries.region_daily(d.fact("llm_request")), "request_cnt_1d", "w_region_daily"),
    "agent_team_daily": (Data.agent_team_daily, "run_cnt_1d", "w_agent_team_daily"),
    "feature_hourly": (Data.feature_hourly, "request_cnt_1h", "w_feature_hourly"),
    "session_daily": (Data.session_daily, "session_cnt_1d", "w_session_daily"),
    "handoff_daily": (Data.handoff_daily, "handoff_cnt_1d", "w_handoff_daily"),
    "platform_health_daily": (Data.platform_daily, "case when is_breach then 1 else 0 end", "w_platform_daily"),
}
register(
    "verify_summary_totals",
    lambda spark, sf_dir: consumer.summary_control_totals({n: (b(Shared(spark, sf_dir)), F.expr(c)) for n, (b, c, _) in _CONTROLS.items()}),
    " union all ".join(
        f"select '{n}' as table_name, count(*) as row_count, cast(sum({c}) as bigint) as control_total from {t}"
        for n, (_, c, t) in _CONTROLS.items()
    ),
)
register(
    "verify_reconciliation",
    _on(
        lambda d: consumer.reconciliation(
            facts.validated(d.raw("llm_request"), "llm_request"), d.feature_daily(), "request_count"
        )
    ),
    "select *, source_rows = valid_rows + quarantine_rows as split_balances, summary_total = valid_rows as summary_balances from ("
    "select (select count(*) from v_llm_request) as source_rows, (select count(*) from f_llm_request) as valid_rows, "
    "(select count(*) from v_llm_request) - (select count(*) from f_llm_request) as quarantine_rows, "
    "(select cast(sum(request_count) as bigint) from w_feature_daily) as summary_total) t",
)
