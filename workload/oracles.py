"""DuckDB SQL with the same results as the registered queries.

Written on its own terms: grouped SQL, window functions and joins, with
rounding as whole-number arithmetic (half up).
"""

from __future__ import annotations

import re

from workload.fact_oracles import RULES
from workload.views import FACTS, VIEWS


def up(numerator: str, denominator: str, digits: int) -> str:
    """Half-up rounded ratio of non-negative whole numbers."""
    scale = 2 * 10**digits
    n, d = f"cast({numerator} as hugeint)", f"cast({denominator} as hugeint)"
    return f"(cast(({n} * {scale} + {d}) // nullif(2 * {d}, 0) as double) / {10**digits})"


def mean(column: str, digits: int = 2) -> str:
    return up(f"sum({column})", f"count({column})", digits)


def big(expression: str) -> str:
    return f"cast({expression} as bigint)"


STEPS = "1000000000000"


def units(column: str) -> str:
    """USD as whole 1e-12 steps, from the shortest decimal text of the double."""
    return f"cast(cast(cast({column} as varchar) as decimal(25, 12)) * cast({STEPS} as decimal(13, 0)) as hugeint)"


def usd_sum(column: str = "estimated_cost_usd") -> str:
    return f"cast(sum({units(column)}) as double) / {STEPS}"


def cents(column: str) -> str:
    """A two-digit value as a whole number of hundredths."""
    return f"cast(round({column} * 100) as hugeint)"


def rounded(value: str, digits: int) -> str:
    """Half-up rounding of the shortest decimal text of a double."""
    return f"cast(round(cast(cast({value} as varchar) as decimal(38, 18)), {digits}) as double)"


CTES: dict[str, str] = {}


def _cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


for _name, _sql in VIEWS.items():
    _cte(f"v_{_name}", _sql)
for _name in FACTS:
    holds = " and ".join(f"coalesce({rule}, true)" for _, rule in RULES.get(_name, ())) or "true"
    _cte(f"f_{_name}", f"select * from v_{_name} where {holds}")


def _requests(keys: str, names: tuple[str, ...], source: str = "f_llm_request") -> str:
    n, ok, err, p, c, t, cost = names
    return f"""
select {keys}, count(*) as {n}, count(*) filter (status = 'success') as {ok},
  count(*) filter (status = 'error') as {err}, {big('sum(prompt_tokens)')} as {p},
  {big('sum(completion_tokens)')} as {c}, {big('sum(total_tokens)')} as {t}, {usd_sum()} as {cost},
  {mean('latency_ms')} as avg_latency_ms, max(latency_ms) as max_latency_ms,
  quantile_disc(latency_ms, 0.95) as p95_latency_ms
from {source} group by all"""


def _names(period: str) -> tuple[str, ...]:
    stems = "request_cnt success_cnt error_cnt prompt_token_cnt completion_token_cnt total_token_cnt estimated_cost_amt"
    return tuple(f"{stem}_{period}" for stem in stems.split())


_LONG = ("request_count", "success_count", "error_count", "prompt_tokens", "completion_tokens", "total_tokens", "estimated_cost_usd")
_cte("w_feature_daily", _requests("date, app_name, feature_name, model_name", _LONG))
_cte(
    "w_feature_hourly",
    _requests("date, cast(extract(hour from created_at) as int) as hour, app_name, feature_name, model_name", _names("1h")),
)
_cte("w_feature_env_daily", _requests("date, app_name, feature_name, model_name, environment", _names("1d")))
_cte("w_region_daily", _requests("date, region, environment, app_name, model_name", _names("1d")))
_cte(
    "w_feature_daily_from_hourly",
    f"""
select date, app_name, feature_name, model_name, {big('sum(request_cnt_1h)')} as request_count,
  {big('sum(success_cnt_1h)')} as success_count, {big('sum(error_cnt_1h)')} as error_count,
  {big('sum(prompt_token_cnt_1h)')} as prompt_tokens, {big('sum(completion_token_cnt_1h)')} as completion_tokens,
  {big('sum(total_token_cnt_1h)')} as total_tokens, {usd_sum('estimated_cost_amt_1h')} as estimated_cost_usd,
  {up(f"sum({cents('avg_latency_ms')} * request_cnt_1h)", '100 * sum(request_cnt_1h)', 2)} as avg_latency_ms,
  max(max_latency_ms) as max_latency_ms
from w_feature_hourly group by all""",
)
_cte(
    "w_session_daily",
    f"""
select s.date, s.app_name, s.feature_name, count(*) as session_cnt_1d,
  {up('sum(turns)', 'count(*)', 2)} as avg_turns_per_session,
  {up('sum(tokens)', 'count(*)', 2)} as avg_tokens_per_session,
  {up('sum(duration)', '100 * count(*)', 2)} as avg_duration_per_session_ms,
  count(r.session_id) as resolved_session_cnt_1d
from (
  select date, app_name, feature_name, session_id, count(*) as turns, sum(total_tokens) as tokens,
    (max(epoch_us(created_at) + latency_ms * 1000) - min(epoch_us(created_at)) + 5) // 10 as duration
  from f_llm_request group by all) s
left join (
  select distinct date, app_name, feature_name, session_id from f_feedback
  where feedback_type = 'thumbs_up' or (feedback_type = 'rating' and rating_value >= 4)) r
on s.date = r.date and s.app_name = r.app_name and s.feature_name = r.feature_name and s.session_id = r.session_id
group by all""",
)


def _agents(team: bool) -> str:
    keys = ("date, team_id, " if team else "date, ") + "app_name, agent_id, agent_name, task_type"
    run, amt = ("_cnt_1d", "estimated_cost_amt_1d") if team else ("_count", "estimated_cost_usd")
    tokens = "total_token_cnt_1d" if team else "total_tokens"
    teams = (
        "select r.*, coalesce(u.team_id, 'unknown') as team_id from f_agent_run r left join v_user_dim u on r.user_id = u.user_id"
        if team
        else "select * from f_agent_run"
    )
    on = " and ".join(f"a.{k.strip()} = b.{k.strip()}" for k in keys.split(","))
    out = ", ".join(f"a.{k.strip()}" for k in keys.split(","))
    return f"""
with runs as ({teams}),
a as (
  select {keys}, count(*) as n, count(*) filter (status = 'success') as ok, count(*) filter (status = 'error') as bad,
    sum(turn_count) as turns, sum(llm_call_count) as calls, sum(tool_call_count) as tools,
    sum(retrieval_count) as retrievals, sum(total_tokens) as tokens, {usd_sum()} as cost,
    {mean('duration_ms')} as mean_ms, quantile_disc(duration_ms, 0.95) as p95_ms
  from runs group by all),
b as (
  select {', '.join('runs.' + k.strip() for k in keys.split(','))}, count(*) as spans,
    count(*) filter (s.status = 'error') as failed, count(*) filter (span_type = 'tool_call') as tool_spans,
    count(*) filter (span_type = 'llm_call') as llm_spans
  from f_agent_span s join runs on s.date = runs.date and s.agent_id = runs.agent_id and s.run_id = runs.run_id
  group by all)
select {out}, n as run{run}, ok as success{run}, bad as error{run}, {big('turns')} as turn{run},
  {big('calls')} as llm_call{run}, {big('tools')} as tool_call{run}, {big('retrievals')} as retrieval{run},
  {big('tokens')} as {tokens}, cost as {amt}, mean_ms as avg_duration_ms, p95_ms as p95_duration_ms,
  coalesce(spans, 0) as span{run}, coalesce(failed, 0) as failed_span{run}, coalesce(tool_spans, 0) as tool_span{run},
  coalesce(llm_spans, 0) as llm_span{run}
from a left join b on {on}"""


_cte("w_agent_daily", _agents(False))
_cte("w_agent_team_daily", _agents(True))
_cte(
    "w_tool_daily",
    f"""
select date, agent_id, tool_name, tool_type, count(*) as tool_call_count,
  count(*) filter (status = 'success') as success_count, count(*) filter (status = 'error') as error_count,
  {big('sum(retry_count)')} as retry_count, {mean('duration_ms')} as avg_duration_ms,
  quantile_disc(duration_ms, 0.95) as p95_duration_ms, {mean('result_size')} as avg_result_size,
  max(result_size) as max_result_size
from f_tool_call group by all""",
)
_cte(
    "w_handoff_daily",
    f"""
select date, parent_agent_id, child_agent_id, handoff_type, count(*) as handoff_cnt_1d,
  count(*) filter (status = 'success') as success_cnt_1d, count(*) filter (status = 'error') as error_cnt_1d,
  count(*) filter (status = 'timeout') as timeout_cnt_1d, {mean('handoff_latency_ms')} as avg_handoff_latency_ms,
  cast(quantile_disc(handoff_latency_ms, 0.95) as bigint) as p95_handoff_latency_ms
from f_handoff group by all""",
)
_cte(
    "w_retrieval_daily",
    f"""
select date, app_name, knowledge_base_id, embedding_model, retrieval_strategy, count(*) as retrieval_cnt_1d,
  count(*) filter (status = 'success') as success_cnt_1d, count(*) filter (status = 'error') as error_cnt_1d,
  count(*) filter (returned_count = 0) as zero_result_cnt_1d, {big('sum(returned_count)')} as returned_cnt_1d,
  {big('sum(hit_count)')} as hit_cnt_1d, {up('sum(avg_similarity_pct)', '100 * count(*)', 4)} as avg_similarity_score,
  {mean('total_latency_ms')} as avg_total_latency_ms, quantile_disc(total_latency_ms, 0.95) as p95_total_latency_ms,
  {mean('embedding_latency_ms')} as avg_embedding_latency_ms, {mean('search_latency_ms')} as avg_search_latency_ms
from f_retrieval group by all""",
)
_cte(
    "w_feedback_daily",
    f"""
select date, app_name, feature_name, agent_id, count(*) as feedback_cnt_1d,
  count(*) filter (feedback_type = 'thumbs_up') as thumbs_up_cnt_1d,
  count(*) filter (feedback_type = 'thumbs_down') as thumbs_down_cnt_1d,
  count(*) filter (feedback_type = 'regenerate') as regenerate_cnt_1d,
  count(*) filter (feedback_type = 'report') as report_cnt_1d, {mean('rating_value')} as avg_rating,
  count(distinct request_id) as rated_request_cnt_1d
from f_feedback group by all""",
)
_cte(
    "w_guardrail_daily",
    f"""
select date, app_name, rule_category, action_taken, count(*) as check_cnt_1d,
  count(*) filter (triggered) as triggered_cnt_1d, count(*) filter (action_taken = 'block') as block_cnt_1d,
  count(*) filter (action_taken = 'redact') as redact_cnt_1d, count(*) filter (action_taken = 'warn') as warn_cnt_1d,
  {mean('guardrail_latency_ms')} as avg_guardrail_latency_ms, count(distinct user_id) as distinct_user_cnt_1d
from f_guardrail group by all""",
)
_cte(
    "w_evaluation_daily",
    f"""
select date, app_name, feature_name, evaluation_dimension, evaluated_model_name, count(*) as evaluation_cnt_1d,
  count(*) filter (passed) as pass_cnt_1d, count(*) filter (not passed) as fail_cnt_1d,
  {up('sum(score_pct)', '100 * count(*)', 4)} as avg_score, quantile_disc(score, 0.1) as p10_score,
  {mean('evaluation_latency_ms')} as avg_evaluation_latency_ms
from f_evaluation group by all""",
)
_cte(
    "w_team_cost_daily",
    f"""
select l.*, coalesce(g.runs, 0) as agent_run_cnt_1d, coalesce(g.cost, 0.0) as agent_cost_amt_1d
from (
  select date, coalesce(team_id, 'unknown') as team_id, app_name, model_name, count(*) as request_cnt_1d,
    {big('sum(total_tokens)')} as total_token_cnt_1d, {usd_sum()} as estimated_cost_amt_1d
  from f_llm_request r left join v_user_dim u on r.user_id = u.user_id group by all) l
left join (
  select date, coalesce(team_id, 'unknown') as team_id, app_name, count(*) as runs, {usd_sum()} as cost
  from f_agent_run r left join v_user_dim u on r.user_id = u.user_id group by all) g
on l.date = g.date and l.team_id = g.team_id and l.app_name = g.app_name""",
)
_cte(
    "w_prompt_daily",
    f"""
with named as (
  select *, coalesce(nullif(trim(prompt_id), ''), 'unknown') as pid from f_llm_request),
keyed as (
  select distinct date, request_id, pid, prompt_version, model_name from named where trim(request_id) <> ''),
counted as (select date, request_id, count(*) as k from keyed group by all),
single as (select keyed.* from keyed join counted using (date, request_id) where k = 1),
conflict as (
  select date, pid, prompt_version, model_name, count(distinct request_id) as conflicts
  from keyed join counted using (date, request_id) where k > 1 group by all),
req as (
  select date, pid, prompt_version, model_name, count(*) as request_cnt_1d,
    count(*) filter (status = 'success') as success_cnt_1d, count(*) filter (status = 'error') as error_cnt_1d,
    {mean('latency_ms')} as avg_latency_ms, quantile_disc(latency_ms, 0.95) as p95_latency_ms,
    {big('sum(total_tokens)')} as total_token_cnt_1d, {usd_sum()} as estimated_cost_amt_1d
  from named group by all),
ev as (
  select e.date, coalesce(s.pid, 'unknown') as pid, coalesce(s.prompt_version, e.evaluated_prompt_version) as prompt_version,
    coalesce(s.model_name, e.evaluated_model_name) as model_name, count(*) as n, count(*) filter (passed) as passes,
    count(*) filter (not passed) as fails, sum(score_pct) as pct, count(score) as den
  from f_evaluation e left join single s on e.date = s.date and e.request_id = s.request_id group by all)
select req.date, req.pid as prompt_id, req.prompt_version, req.model_name, request_cnt_1d, success_cnt_1d, error_cnt_1d,
  avg_latency_ms, p95_latency_ms, total_token_cnt_1d, estimated_cost_amt_1d, coalesce(n, 0) as evaluation_cnt_1d,
  coalesce(passes, 0) as pass_cnt_1d, coalesce(fails, 0) as fail_cnt_1d,
  cast(coalesce(pct, 0) as double) / 100 as evaluation_score_num_1d, coalesce(den, 0) as evaluation_score_den_1d,
  case when den > 0 then {up('pct', '100 * den', 4)} end as avg_evaluation_score,
  coalesce(conflicts, 0) as metadata_conflict_cnt_1d
from req left join ev using (date, pid, prompt_version, model_name)
left join conflict using (date, pid, prompt_version, model_name)""",
)
_cte(
    "w_platform_daily",
    """
select *, metric_value > threshold as is_breach from (
  select date, component, metric_name, max(metric_value) as metric_value, max(threshold) as threshold
  from f_platform_health group by all) t""",
)

# --- marts -----------------------------------------------------------------

_cte(
    "m_cost_anomalies",
    """
select *, coalesce(cost_change_rate > 2.0, false) as is_anomaly from (
  select *, case when prev_day_cost > 0 then (estimated_cost_usd - prev_day_cost) / prev_day_cost end as cost_change_rate
  from (
    select date, app_name, feature_name, model_name, request_count, estimated_cost_usd,
      lag(estimated_cost_usd) over (partition by app_name, feature_name, model_name order by date) as prev_day_cost
    from w_feature_daily) a) b""",
)
_cte(
    "m_sla_report",
    """
select date, app_name, w.feature_name, model_name, request_count, error_count, p95_latency_ms,
  coalesce(error_count / nullif(request_count, 0), 0.0) as error_rate, p95_latency_ms_max, error_rate_max,
  p95_latency_ms > p95_latency_ms_max as is_latency_breach,
  coalesce(error_count / nullif(request_count, 0), 0.0) > error_rate_max as is_error_breach
from w_feature_daily w left join v_sla_rule r on w.feature_name = r.feature_name""",
)
_cte(
    "m_prompt_metrics",
    """
select date, prompt_id, prompt_version, model_name, request_cnt_1d as request_count, success_cnt_1d as success_count,
  error_cnt_1d as error_count, total_token_cnt_1d as total_tokens, estimated_cost_amt_1d as estimated_cost_usd,
  avg_latency_ms, p95_latency_ms, evaluation_cnt_1d as evaluation_count, pass_cnt_1d as pass_count,
  fail_cnt_1d as fail_count, evaluation_score_num_1d as evaluation_score_numerator,
  evaluation_score_den_1d as evaluation_score_denominator, avg_evaluation_score,
  metadata_conflict_cnt_1d as metadata_conflict_count
from w_prompt_daily""",
)


def _prompt_comparison(keys: str) -> str:
    def share(num: str, den: str) -> str:
        return f"case when sum({den}) > 0 then {up(f'sum({num})', f'sum({den})', 6)} end"

    pct = "sum(cast(round(evaluation_score_numerator * 100) as bigint))"
    return f"""
select {keys}, {big('sum(request_count)')} as request_count, {big('sum(success_count)')} as success_count,
  {big('sum(error_count)')} as error_count, {big('sum(total_tokens)')} as total_tokens,
  {usd_sum()} as estimated_cost_usd,
  {up(f"sum({cents('avg_latency_ms')} * request_count)", '100 * sum(request_count)', 2)} as avg_latency_ms,
  max(p95_latency_ms) as max_daily_p95_latency_ms, {big('sum(evaluation_count)')} as evaluation_count,
  {big('sum(pass_count)')} as pass_count, {big('sum(fail_count)')} as fail_count,
  cast({pct} as double) / 100 as evaluation_score_numerator,
  {big('sum(evaluation_score_denominator)')} as evaluation_score_denominator,
  {big('sum(metadata_conflict_count)')} as metadata_conflict_count,
  {share('success_count', 'request_count')} as success_rate, {share('error_count', 'request_count')} as error_rate,
  {share('pass_count', 'evaluation_count')} as pass_rate,
  case when sum(evaluation_score_denominator) > 0 then {up(pct, '100 * sum(evaluation_score_denominator)', 6)} end
    as avg_evaluation_score
from m_prompt_metrics group by all"""


_cte("m_prompt_comparison", _prompt_comparison("prompt_id, prompt_version, model_name"))
_cte("m_prompt_comparison_by_version", _prompt_comparison("prompt_version"))
_cte(
    "m_retrieval_quality",
    f"""
select *, p95_total_latency_ms > p95_total_latency_ms_max as is_latency_breach,
  zero_result_rate_1d > zero_result_rate_max as is_zero_result_breach
from (
  select date, app_name, knowledge_base_id, embedding_model, retrieval_strategy, retrieval_cnt_1d, zero_result_cnt_1d,
    returned_cnt_1d, hit_cnt_1d, {up('zero_result_cnt_1d', 'retrieval_cnt_1d', 4)} as zero_result_rate_1d,
    {up('hit_cnt_1d', 'returned_cnt_1d', 4)} as hit_rate_1d, p95_total_latency_ms,
    cast(2000 as bigint) as p95_total_latency_ms_max, cast(0.1 as double) as zero_result_rate_max
  from w_retrieval_daily) t""",
)
_cte(
    "m_satisfaction",
    f"""
select *, satisfaction_rate_1d < satisfaction_rate_min as is_satisfaction_breach,
  regeneration_rate_1d > regeneration_rate_max as is_regeneration_breach
from (
  select w.date, w.app_name, w.feature_name, agent_id, feedback_cnt_1d, thumbs_up_cnt_1d, thumbs_down_cnt_1d,
    regenerate_cnt_1d, request_cnt_1d, {up('thumbs_up_cnt_1d', '(thumbs_up_cnt_1d + thumbs_down_cnt_1d)', 4)} as satisfaction_rate_1d,
    {up('regenerate_cnt_1d', 'request_cnt_1d', 4)} as regeneration_rate_1d,
    cast(0.8 as double) as satisfaction_rate_min, cast(0.15 as double) as regeneration_rate_max
  from w_feedback_daily w left join (
    select date, app_name, feature_name, {big('sum(request_count)')} as request_cnt_1d from w_feature_daily group by all) r
  on w.date = r.date and w.app_name = r.app_name and w.feature_name = r.feature_name) t""",
)
_cte(
    "m_guardrail_violations",
    f"""
select *, trigger_rate_1d > trigger_rate_max as is_trigger_rate_breach,
  avg_guardrail_latency_ms > p95_latency_ms_max as is_latency_breach
from (
  select date, app_name, rule_category, action_taken, check_cnt_1d, triggered_cnt_1d, block_cnt_1d,
    avg_guardrail_latency_ms, {up('triggered_cnt_1d', 'check_cnt_1d', 4)} as trigger_rate_1d,
    {up('block_cnt_1d', 'check_cnt_1d', 4)} as block_rate_1d, cast(0.2 as double) as trigger_rate_max,
    cast(300 as bigint) as p95_latency_ms_max
  from w_guardrail_daily) t""",
)
_cte(
    "m_team_app_daily",
    f"""
select date, team_id, app_name, {big('sum(request_cnt_1d)')} as request_cnt_1d,
  {big('sum(total_token_cnt_1d)')} as total_token_cnt_1d, {big(f"sum({units('estimated_cost_amt_1d')})")} as model_units,
  max(agent_run_cnt_1d) as agent_run_cnt_1d, max({units('agent_cost_amt_1d')}) as agent_units
from w_team_cost_daily group by all""",
)
_cte(
    "m_daily_budget",
    f"""
with spent as (
  select *, model_units + agent_units as day_units,
    sum(model_units + agent_units) over (partition by team_id, app_name, date_trunc('month', date) order by date) as mtd
  from m_team_app_daily),
rated as (
  select s.*, team_name, department, cost_center, budget_monthly_usd as budget,
    {up('mtd', STEPS, 6)} as mtd_amt,
    {up('mtd * day(last_day(date))', f'{STEPS} * day(date)', 6)} as projected
  from spent s left join v_team_dim t on s.team_id = t.team_id)
select date, team_id, team_name, department, cost_center, app_name, request_cnt_1d, total_token_cnt_1d,
  cast(model_units as double) / {STEPS} as estimated_cost_amt_1d, agent_run_cnt_1d,
  cast(agent_units as double) / {STEPS} as agent_cost_amt_1d, cast(day_units as double) / {STEPS} as total_cost_amt_1d,
  mtd_amt as cost_mtd_amt, projected as projected_month_end_cost_amt, budget as budget_monthly_amt,
  {up('round(mtd_amt * 1000000)', 'budget * 1000000', 4)} as budget_utilization_rate_mtd,
  projected > budget as is_budget_breach
from rated""",
)
# The budget as first defined: agent cost is added up over the model rows it stands on.
_cte("m_team_app_daily_copies", CTES["m_team_app_daily"].replace("max(", "sum("))
CTES["m_team_app_daily_copies"] = re.sub(r"sum\(agent_run_cnt_1d\)", "cast(sum(agent_run_cnt_1d) as bigint)", CTES["m_team_app_daily_copies"])
_cte("m_daily_budget_copies", CTES["m_daily_budget"].replace("m_team_app_daily", "m_team_app_daily_copies"))
_cte(
    "m_monthly_chargeback",
    f"""
with monthly as (
  select cast(date_trunc('month', date) as date) as month_start_date, team_id,
    {big('sum(request_cnt_1d)')} as request_cnt_1m, {big('sum(total_token_cnt_1d)')} as total_token_cnt_1m,
    sum(model_units) as mu, {big('sum(agent_run_cnt_1d)')} as agent_run_cnt_1m, sum(agent_units) as au
  from m_team_app_daily group by all),
rated as (
  select m.*, team_name, department, cost_center, budget_monthly_usd as budget, {up('mu + au', STEPS, 6)} as charge
  from monthly m left join v_team_dim t on m.team_id = t.team_id)
select month_start_date, team_id, team_name, department, cost_center, request_cnt_1m, total_token_cnt_1m,
  cast(mu as double) / {STEPS} as llm_cost_amt_1m, agent_run_cnt_1m, cast(au as double) / {STEPS} as agent_cost_amt_1m,
  charge as chargeback_amt_1m, budget as budget_monthly_amt, round(budget - charge, 6) as budget_variance_amt_1m,
  {up('round(charge * 1000000)', 'budget * 1000000', 4)} as budget_utilization_rate_1m,
  coalesce(charge > budget, false) as is_budget_overrun
from rated""",
)
_cte(
    "m_weekly_summary",
    f"""
with l as (
  select date_trunc('week', date) as wk, app_name, sum(request_count) as a1, sum(success_count) as a2, sum(error_count) as a3,
    sum(total_tokens) as a4, sum({units('estimated_cost_usd')}) as a5, max(p95_latency_ms) as a6,
    sum({cents('avg_latency_ms')} * request_count) as a7 from w_feature_daily group by all),
g as (
  select date_trunc('week', date) as wk, app_name, sum(run_count) as b1, sum(success_count) as b2, sum(error_count) as b3,
    sum({units('estimated_cost_usd')}) as b4 from w_agent_daily group by all),
r as (
  select date_trunc('week', date) as wk, app_name, sum(retrieval_cnt_1d) as c1, sum(returned_cnt_1d) as c2,
    sum(hit_cnt_1d) as c3 from w_retrieval_daily group by all),
f as (
  select date_trunc('week', date) as wk, app_name, sum(feedback_cnt_1d) as d1, sum(thumbs_up_cnt_1d) as d2,
    sum(thumbs_down_cnt_1d) as d3 from w_feedback_daily group by all),
k as (
  select date_trunc('week', date) as wk, app_name, sum(check_cnt_1d) as e1, sum(triggered_cnt_1d) as e2,
    sum(block_cnt_1d) as e3 from w_guardrail_daily group by all),
e as (
  select date_trunc('week', date) as wk, app_name, sum(evaluation_cnt_1d) as g1, sum(pass_cnt_1d) as g2,
    sum(fail_cnt_1d) as g3, sum(cast(round(avg_score * 10000) as hugeint) * evaluation_cnt_1d) as g4
  from w_evaluation_daily group by all),
j as (
  select * from l full join g using (wk, app_name) full join r using (wk, app_name) full join f using (wk, app_name)
  full join k using (wk, app_name) full join e using (wk, app_name))
select cast(wk as date) as week_start_date, app_name, {', '.join(
    f"cast(coalesce({c}, 0) as bigint) as {n}" for c, n in (
        ("a1", "request_cnt_1w"), ("a2", "success_cnt_1w"), ("a3", "error_cnt_1w"), ("a4", "total_token_cnt_1w"),
        ("b1", "agent_run_cnt_1w"), ("b2", "agent_success_cnt_1w"), ("b3", "agent_error_cnt_1w"),
        ("c1", "retrieval_cnt_1w"), ("c2", "retrieval_returned_cnt_1w"), ("c3", "retrieval_hit_cnt_1w"),
        ("d1", "feedback_cnt_1w"), ("d2", "thumbs_up_cnt_1w"), ("d3", "thumbs_down_cnt_1w"),
        ("e1", "guardrail_check_cnt_1w"), ("e2", "guardrail_triggered_cnt_1w"), ("e3", "guardrail_block_cnt_1w"),
        ("g1", "evaluation_cnt_1w"), ("g2", "evaluation_pass_cnt_1w"), ("g3", "evaluation_fail_cnt_1w")))},
  cast(coalesce(a5, 0) as double) / {STEPS} as llm_cost_amt_1w, cast(a6 as bigint) as p95_latency_ms_max,
  cast(coalesce(b4, 0) as double) / {STEPS} as agent_cost_amt_1w, {up('a7', '100 * a1', 2)} as avg_latency_ms,
  {up('c3', 'c2', 4)} as retrieval_hit_rate_1w, {up('d2', '(d2 + d3)', 4)} as satisfaction_rate_1w,
  {up('g2', 'g1', 4)} as evaluation_pass_rate_1w, {up('g4', '10000 * g1', 4)} as avg_evaluation_score,
  cast(coalesce(a5, 0) + coalesce(b4, 0) as double) / {STEPS} as total_ai_cost_amt_1w
from j""",
)

_END = "{start} + to_milliseconds({took})"


def _node(kind: str, view: str, node_id: str, name: str, took: str, start: str, **given: str) -> str:
    text = (
        "run_id span_id request_id tool_call_id retrieval_id app_name feature_name user_id session_id agent_id agent_name "
        "model_name provider knowledge_base_id prompt_hash response_hash query_text_hash"
    ).split()
    cols = ", ".join(f"{given.get(c, chr(39) * 2)} as {c}" for c in text)
    return (
        f"select date, trace_id, '{kind}' as node_type, {node_id} as node_id, {name} as node_name, status, "
        f"cast({took} as bigint) as latency_ms, {given.get('cost', '0.0::double')} as cost_usd, "
        f"{given.get('tokens', '0')}::bigint as tokens, {given.get('inp', '0')}::bigint as input_size, "
        f"{given.get('outp', '0')}::bigint as output_size, {start} as started, "
        f"{start} + to_milliseconds({took}) as ended, {cols}, {given.get('d1', '0')} as d1, {given.get('d2', '0')} as d2, "
        f"{given.get('d3', '0')} as d3 from {view}"
    )


_same = {c: c for c in ("run_id", "app_name", "feature_name", "user_id", "session_id", "agent_id", "agent_name", "span_id", "request_id", "model_name", "knowledge_base_id")}


def _pick(*names: str) -> dict[str, str]:
    return {n: _same[n] for n in names}


_first = lambda c: f"arg_min({c}, (started, node_type, node_id)) filter ({c} <> '')"
_cte(
    "m_trace_health",
    f"""
with nodes as (
  {_node('llm_generation', 'f_llm_request', 'request_id', 'model_name', 'latency_ms', 'created_at', cost='estimated_cost_usd', tokens='total_tokens', **_pick('run_id', 'request_id', 'app_name', 'feature_name', 'user_id', 'session_id', 'model_name'))}
  union all
  {_node('orchestration', 'f_agent_run', 'run_id', 'task_type', 'duration_ms', 'start_time', cost='estimated_cost_usd', tokens='total_tokens', d1='llm_call_count', d2='tool_call_count', d3='retrieval_count', **_pick('run_id', 'app_name', 'user_id', 'session_id', 'agent_id', 'agent_name'))}
  union all
  {_node('agent_span', 'f_agent_span', 'span_id', 'span_name', 'duration_ms', 'start_time', **_pick('run_id', 'span_id', 'agent_id'))}
  union all
  {_node('tool_call', 'f_tool_call', 'tool_call_id', 'tool_name', 'duration_ms', 'created_at', outp='result_size', tool_call_id='tool_call_id', **_pick('run_id', 'span_id', 'agent_id'))}
  union all
  {_node('retrieval', 'f_retrieval', 'retrieval_id', 'knowledge_base_name', 'total_latency_ms', 'created_at', outp='returned_count', retrieval_id='retrieval_id', model_name='embedding_model', **_pick('run_id', 'request_id', 'app_name', 'feature_name', 'user_id', 'knowledge_base_id'))}),
scored as (
  select *, status in ('error', 'failed', 'timeout') as failed, latency_ms >= 5000 as slow,
    case when status in ('error', 'failed', 'timeout') then 3 when latency_ms >= 5000 then 2 when cost_usd >= 1.0 then 1
      else 0 end as severity
  from nodes where trace_id <> ''),
worst as (
  select * from scored qualify row_number() over (
    partition by trace_id order by severity desc, latency_ms desc, cost_usd desc, node_type, node_id) = 1),
t as (
  select trace_id, min(date) as date, {_first('run_id')} as run_id, {_first('app_name')} as app_name,
    {_first('feature_name')} as feature_name, {_first('user_id')} as user_id, {_first('session_id')} as session_id,
    {_first('agent_id')} as agent_id, {_first('agent_name')} as agent_name,
    epoch_ms(max(ended)) - epoch_ms(min(started)) as trace_latency_ms,
    cast(greatest(sum(case when node_type = 'llm_generation' then {units('cost_usd')} else 0 end),
      max(case when node_type = 'orchestration' then {units('cost_usd')} else 0 end)) as double) / {STEPS} as trace_cost_usd,
    cast(greatest(sum(case when node_type = 'llm_generation' then tokens else 0 end),
      max(case when node_type = 'orchestration' then tokens else 0 end)) as bigint) as trace_total_tokens,
    bool_or(failed) as is_failed_trace,
    bool_or(failed and node_type <> 'orchestration') as has_failed_child_observation,
    bool_or(slow and node_type <> 'orchestration') as has_slow_child_observation,
    cast(sum(d1) as bigint) as declared_llm_call_count, cast(sum(d2) as bigint) as declared_tool_call_count,
    cast(sum(d3) as bigint) as declared_retrieval_count,
    count(*) filter (node_type = 'llm_generation') as observed_llm_request_count,
    count(*) filter (node_type = 'tool_call') as observed_tool_call_count,
    count(*) filter (node_type = 'retrieval') as observed_retrieval_count
  from scored group by trace_id),
judged as (
  select *, trace_cost_usd >= 1.0 as is_high_cost_trace, trace_latency_ms >= 30000 as is_slow_trace,
    case when is_failed_trace then 'error' else 'success' end as trace_status,
    declared_llm_call_count > observed_llm_request_count or declared_tool_call_count > observed_tool_call_count
      or declared_retrieval_count > observed_retrieval_count as has_missing_child_facts
  from t)
select j.*, w.span_id, w.request_id, w.tool_call_id, w.retrieval_id, w.model_name, w.provider, w.knowledge_base_id,
  w.node_type as bottleneck_node_type, w.node_id as bottleneck_node_id, w.node_name as bottleneck_name,
  w.status as bottleneck_status, '' as bottleneck_error_type, w.latency_ms as bottleneck_latency_ms,
  w.cost_usd as bottleneck_cost_usd, w.input_size as bottleneck_input_size, w.output_size as bottleneck_output_size,
  w.prompt_hash, w.response_hash, w.query_text_hash,
  concat(w.node_type, ':', w.node_id, ':', w.status, '::', w.latency_ms, 'ms') as child_observation_summary
from judged j join worst w on j.trace_id = w.trace_id
where is_high_cost_trace or is_slow_trace or is_failed_trace or has_failed_child_observation or has_slow_child_observation
  or has_missing_child_facts""",
)
_cte(
    "m_variants",
    f"""
with one_variant as (
  select request_id, dataset_name, experiment_name, min(variant_name) as variant_name from v_experiment_assignment
  group by all having count(distinct variant_name) = 1)
select dataset_name, experiment_name, variant_name, evaluated_model_name as model_name,
  evaluated_prompt_version as prompt_version, evaluation_dimension, min(e.date) as d0, max(e.date) as d1,
  count(*) as evaluation_count, count(*) filter (passed) as pass_count, count(*) filter (not passed) as fail_count,
  sum(score_pct) as pct, count(score) as score_denominator, sum(coalesce(latency_ms, 0)) as lat, count(latency_ms) as timed,
  sum(coalesce({units('estimated_cost_usd')}, 0)) as cost, count(estimated_cost_usd) as costed
from f_evaluation e join one_variant a on e.request_id = a.request_id left join f_llm_request r on e.request_id = r.request_id
group by all""",
)
_cte(
    "m_regression",
    f"""
select c.dataset_name, c.experiment_name, c.baseline_variant, c.candidate_variant, b.model_name as baseline_model_name,
  b.prompt_version as baseline_prompt_version, k.model_name as candidate_model_name,
  k.prompt_version as candidate_prompt_version, b.evaluation_dimension, least(b.d0, k.d0) as experiment_start_date,
  greatest(b.d1, k.d1) as experiment_end_date, {', '.join(
      f"{a}.evaluation_count as {r}_evaluation_count, {a}.pass_count as {r}_pass_count, {a}.fail_count as {r}_fail_count, "
      f"cast({a}.pct as double) / 100 as {r}_score_numerator, {a}.score_denominator as {r}_score_denominator, "
      f"cast({a}.lat as bigint) as {r}_latency_ms_numerator, {a}.timed as {r}_latency_ms_denominator, "
      f"cast({a}.cost as double) / {STEPS} as {r}_estimated_cost_usd_numerator, "
      f"{a}.costed as {r}_estimated_cost_usd_denominator" for a, r in (("b", "baseline"), ("k", "candidate")))}
from v_experiment_comparison c
join m_variants b on c.dataset_name = b.dataset_name and c.experiment_name = b.experiment_name and c.baseline_variant = b.variant_name
join m_variants k on c.dataset_name = k.dataset_name and c.experiment_name = k.experiment_name and c.candidate_variant = k.variant_name
  and b.evaluation_dimension = k.evaluation_dimension""",
)


def _rates(role: str) -> str:
    def share(num: str, den: str, digits: int) -> str:
        return f"case when {role}_{den} > 0 then {up(num, f'{role}_{den}', digits)} end"

    return (
        f"{share(f'{role}_pass_count', 'evaluation_count', 6)} as {role}_pass_rate, "
        f"case when {role}_score_denominator > 0 then "
        f"{up(f'round({role}_score_numerator * 100)', f'100 * {role}_score_denominator', 6)} end as {role}_avg_score, "
        f"{share(f'{role}_latency_ms_numerator', 'latency_ms_denominator', 2)} as {role}_avg_latency_ms, "
        f"case when {role}_estimated_cost_usd_denominator > 0 then "
        f"{up(units(f'{role}_estimated_cost_usd_numerator'), f'{STEPS} * {role}_estimated_cost_usd_denominator', 8)} end "
        f"as {role}_avg_estimated_cost_usd"
    )


_cte(
    "m_comparison",
    f"""
select *, score_delta < 0 or pass_rate_delta < 0 as is_quality_regression, cost_increase_rate > 0 as is_cost_increase,
  latency_increase_rate > 0 as is_latency_increase
from (
  select *, candidate_avg_score - baseline_avg_score as score_delta, candidate_pass_rate - baseline_pass_rate as pass_rate_delta,
    {rounded('((candidate_avg_estimated_cost_usd - baseline_avg_estimated_cost_usd) / nullif(baseline_avg_estimated_cost_usd, 0))', 6)}
      as cost_increase_rate,
    {rounded('((candidate_avg_latency_ms - baseline_avg_latency_ms) / nullif(baseline_avg_latency_ms, 0))', 6)}
      as latency_increase_rate
  from (select *, {_rates('baseline')}, {_rates('candidate')} from m_regression) a) b""",
)


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTEs it needs, in dependency order."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b[vfwma]_[a-z_]+\b", sql)):
            if name in CTES and name not in ordered:
                visit(CTES[name])
                ordered.append(name)

    visit(body)
    if not ordered:
        return body
    parts = ",\n".join(f"{name} as materialized (\n{CTES[name]}\n)" for name in ordered)
    return f"with {parts}\n{body}"
