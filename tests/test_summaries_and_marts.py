from datetime import date, datetime

from lampyris.plans import consumer, marts, summaries
from lampyris.sources import dimensions
from tests.builders import request, rows


def test_hourly_feature(spark):
    frame = rows(
        spark, "llm_request",
        request(1, created_at=datetime(2026, 1, 5, 9, 5), latency_ms=100, total_tokens=15),
        request(2, created_at=datetime(2026, 1, 5, 9, 45), latency_ms=300, status="error", total_tokens=20),
        request(3, created_at=datetime(2026, 1, 5, 10, 1), latency_ms=500),
    )
    out = {r.hour: r for r in summaries.feature_hourly(frame).collect()}
    assert set(out) == {9, 10}
    nine = out[9]
    assert (nine.request_cnt_1h, nine.success_cnt_1h, nine.error_cnt_1h, nine.total_token_cnt_1h) == (2, 1, 1, 35)
    assert (nine.avg_latency_ms, nine.p95_latency_ms) == (200.0, 300)
    daily = summaries.feature_daily_from_hourly(summaries.feature_hourly(frame)).first()
    assert (daily.request_count, daily.max_latency_ms, daily.avg_latency_ms, daily.estimated_cost_usd) == (3, 500, 300.0, 0.03)


def test_sessions(spark):
    frame = rows(
        spark, "llm_request",
        request(1, session_id="s1", created_at=datetime(2026, 1, 5, 9, 0), latency_ms=200, total_tokens=100),
        request(2, session_id="s1", created_at=datetime(2026, 1, 5, 9, 1), latency_ms=300, total_tokens=200),
        request(3, session_id="s2", created_at=datetime(2026, 1, 5, 9, 0), latency_ms=200, total_tokens=100),
    )
    feedback = rows(
        spark, "feedback", dict(feedback_id="f1", session_id="s1", feedback_type="thumbs_up", response_latency_ms=1),
        dict(feedback_id="f2", session_id="s1", feedback_type="rating", rating_value=5, response_latency_ms=1),
        dict(feedback_id="f3", session_id="s2", feedback_type="rating", rating_value=3, response_latency_ms=1),
    )
    row = summaries.session_daily(frame, feedback).first()
    assert (row.session_cnt_1d, row.avg_turns_per_session, row.avg_tokens_per_session) == (2, 1.5, 200.0)
    assert (row.avg_duration_per_session_ms, row.resolved_session_cnt_1d) == (30250.0, 1)


def test_span_counts_stay_with_their_task(spark):
    runs = rows(
        spark, "agent_run", dict(run_id="r1", task_type="a", duration_ms=10), dict(run_id="r2", task_type="b", duration_ms=20),
        dict(run_id="r3", task_type="c", duration_ms=30),
    )
    spans = rows(
        spark, "agent_span", dict(span_id="1", run_id="r1", span_type="tool_call", status="error"),
        dict(span_id="2", run_id="r1", span_type="llm_call"), dict(span_id="3", run_id="r2", span_type="llm_call"),
        dict(span_id="4", run_id="gone", span_type="llm_call"),
    )
    out = {r.task_type: r for r in summaries.agent_daily(runs, spans).collect()}
    counters = {t: (r.span_count, r.failed_span_count, r.tool_span_count, r.llm_span_count) for t, r in out.items()}
    assert counters == {"a": (2, 1, 1, 1), "b": (1, 0, 0, 1), "c": (0, 0, 0, 0)}
    users = spark.createDataFrame([("u1", "team_x")], "user_id string, team_id string")
    assert {r.team_id for r in summaries.agent_team_daily(runs, spans, users).collect()} == {"team_x"}


def test_prompt_conflicts_and_unknown_keys(spark):
    frame = rows(
        spark, "llm_request", request(1, prompt_version="v1"), request(1, prompt_version="v2"), request(2, prompt_id=" "),
        request(3, prompt_version="v1"),
    )
    evaluations = rows(
        spark, "evaluation",
        dict(evaluation_id="e1", request_id="r3", score=0.8, passed=True, evaluated_prompt_version="v9", evaluated_model_name="z"),
        dict(evaluation_id="e2", request_id="r1", score=0.4, passed=False, evaluated_prompt_version="v2", evaluated_model_name="m"),
    )
    out = {(r.prompt_id, r.prompt_version): r for r in summaries.prompt_version_daily(frame, evaluations).collect()}
    assert set(out) == {("p1", "v1"), ("p1", "v2"), ("unknown", "v1")}
    assert [out["p1", v].metadata_conflict_cnt_1d for v in ("v1", "v2")] == [1, 1]
    judged = out["p1", "v1"]
    assert (judged.evaluation_cnt_1d, judged.pass_cnt_1d, judged.avg_evaluation_score) == (1, 1, 0.8)
    # The conflicting request's judgment is not attributed to either key.
    assert out["p1", "v2"].evaluation_cnt_1d == 0 and out["p1", "v2"].avg_evaluation_score is None
    assert summaries.prompt_version_daily(frame).count() == 3


def _team_cost(spark, *data):
    return spark.createDataFrame(
        [(date.fromisoformat(d), t, a, m, n, k, c, r, g) for d, t, a, m, n, k, c, r, g in data],
        "date date, team_id string, app_name string, model_name string, request_cnt_1d bigint, total_token_cnt_1d bigint, "
        "estimated_cost_amt_1d double, agent_run_cnt_1d bigint, agent_cost_amt_1d double",
    )


def _team(spark, budget):
    return spark.createDataFrame(
        [("t", "T", "D", "CC", budget)],
        "team_id string, team_name string, department string, cost_center string, budget_monthly_usd double",
    )


def test_budget_runs_through_the_month(spark):
    cost = _team_cost(
        spark, ("2026-01-01", "t", "a", "m", 1, 1, 10.0, 1, 5.0), ("2026-01-02", "t", "a", "m", 1, 1, 15.0, 1, 5.0)
    )
    first, second = marts.daily_budget(cost, _team(spark, 100.0)).orderBy("date").collect()
    assert (first.cost_mtd_amt, second.cost_mtd_amt) == (15.0, 35.0)
    assert (second.projected_month_end_cost_amt, second.budget_utilization_rate_mtd, second.is_budget_breach) == (542.5, 0.35, True)


def test_agent_cost_is_charged_once(spark):
    cost = _team_cost(
        spark, ("2026-01-01", "t", "a", "m1", 1, 10, 10.0, 1, 5.0), ("2026-01-01", "t", "a", "m2", 1, 10, 15.0, 1, 5.0),
        ("2026-01-02", "t", "a", "m1", 1, 10, 20.0, 1, 10.0),
    )
    row = marts.monthly_chargeback(cost, _team(spark, 100.0)).first()
    assert (row.llm_cost_amt_1m, row.agent_cost_amt_1m, row.chargeback_amt_1m) == (45.0, 15.0, 60.0)
    assert (row.budget_variance_amt_1m, row.budget_utilization_rate_1m, row.is_budget_overrun) == (40.0, 0.6, False)
    day = lambda **kw: marts.daily_budget(cost, _team(spark, 100.0), **kw).orderBy("date").first().agent_cost_amt_1d
    assert (day(), day(agent_cost_per_model=True)) == (5.0, 10.0)


def test_weekly_means_are_weighted(spark):
    requests = rows(spark, "llm_request", *[request(i, latency_ms=100) for i in range(10)]).unionByName(
        rows(spark, "llm_request", *[request(i, latency_ms=300, date=date(2026, 1, 6)) for i in range(30)])
    )
    def judged(n, score, day):
        return [dict(evaluation_id=f"{day}{i}", score=score, passed=True, evaluation_dimension="d", date=day) for i in range(n)]

    evaluations = rows(spark, "evaluation", *judged(2, 0.5, date(2026, 1, 5)), *judged(8, 0.9, date(2026, 1, 6)))
    empty = lambda fact: rows(spark, fact, {}).limit(0)
    row = marts.weekly_summary(
        summaries.feature_daily(requests), summaries.agent_daily(empty("agent_run"), empty("agent_span")),
        summaries.retrieval_daily(empty("retrieval")), summaries.feedback_daily(empty("feedback")),
        summaries.guardrail_daily(empty("guardrail")), summaries.evaluation_daily(evaluations),
    ).first()
    assert (row.week_start_date, row.request_cnt_1w, row.avg_latency_ms, row.avg_evaluation_score) == (date(2026, 1, 5), 40, 250.0, 0.82)
    assert (row.agent_run_cnt_1w, row.retrieval_hit_rate_1w) == (0, None)


def test_anomaly_compares_with_the_previous_row(spark):
    frame = rows(
        spark, "llm_request", request(1, estimated_cost_usd=1.0), request(2, estimated_cost_usd=4.5, date=date(2026, 1, 9))
    )
    out = marts.cost_anomalies(summaries.feature_daily(frame)).orderBy("date").collect()
    assert [(r.cost_change_rate, r.is_anomaly) for r in out] == [(None, False), (3.5, True)]


def test_sla_breaches_and_missing_rule(spark):
    frame = rows(
        spark, "llm_request", *[request(i, latency_ms=4000, status="error" if i == 0 else "success") for i in range(10)],
        request(99, feature_name="other"),
    )
    out = {r.feature_name: r for r in marts.sla_report(summaries.feature_daily(frame), dimensions.sla_rules(spark)).collect()}
    assert (out["chat"].error_rate, out["chat"].is_latency_breach, out["chat"].is_error_breach) == (0.1, True, True)
    assert out["other"].is_latency_breach is None


def test_platform_breach_is_strict(spark):
    day = dict(component="kafka", metric_name="consumer_lag", threshold=10000.0)
    frame = rows(
        spark, "platform_health", day | dict(metric_value=9000.0), day | dict(metric_value=12000.0),
        dict(component="doris", metric_name="x", metric_value=5.0, threshold=5.0),
    )
    out = {r.component: (r.metric_value, r.is_breach) for r in summaries.platform_health_daily(frame).collect()}
    assert out == {"kafka": (12000.0, True), "doris": (5.0, False)}
    assert consumer.kpi_healthy_ratio(summaries.platform_health_daily(frame)).first().value == 0.5


def _experiment(spark, judgments, requests, assignments):
    evaluations = rows(
        spark, "evaluation",
        *[dict(evaluation_id=str(i), request_id=r, evaluation_dimension=d, score=s, passed=p, evaluated_model_name="m",
               evaluated_prompt_version="v") for i, (r, d, s, p) in enumerate(judgments)],
    )
    reqs = rows(spark, "llm_request", *[request(0, request_id=r, latency_ms=l, estimated_cost_usd=c) for r, l, c in requests])
    given = spark.createDataFrame(
        [(r, "ds", "ex", v) for r, v in assignments], "request_id string, dataset_name string, experiment_name string, variant_name string"
    )
    config = spark.createDataFrame(
        [("ds", "ex", "base", "cand"), ("ds", "ex", "base", "base"), ("ds", "ex", "base", "cand")],
        "dataset_name string, experiment_name string, baseline_variant string, candidate_variant string",
    )
    return marts.experiment_regression(evaluations, reqs, given, config)


def test_experiment_components_and_flags(spark):
    components = _experiment(
        spark, [("a", "d", 0.9, True), ("b", "d", 0.5, False), ("c", "d", 0.1, False)],
        [("a", 100, 0.1), ("b", 200, 0.2)], [("a", "base"), (" b ", "cand"), ("c", "base"), ("c", "cand")],
    )
    row = marts.experiment_comparison(components).first()
    # "c" is assigned to both variants and counts for neither.
    assert (row.baseline_evaluation_count, row.candidate_evaluation_count) == (1, 1)
    assert (row.baseline_avg_score, row.candidate_avg_score, row.latency_increase_rate, row.cost_increase_rate) == (0.9, 0.5, 1.0, 1.0)
    assert (row.is_quality_regression, row.is_cost_increase, row.is_latency_increase) == (True, True, True)
    relaxed = marts.experiment_comparison(components, 1.1, 2.0, 2.0).first()
    assert (relaxed.is_quality_regression, relaxed.is_cost_increase, relaxed.is_latency_increase) == (False, False, False)


def test_unmatched_requests_leave_rates_unknown(spark):
    row = marts.experiment_comparison(
        _experiment(spark, [("a", "d", 0.9, True), ("b", "d", 0.5, False)], [("z", 1, 0.1)], [("a", "base"), ("b", "cand")])
    ).first()
    assert (row.baseline_latency_ms_denominator, row.baseline_avg_latency_ms, row.is_latency_increase) == (0, None, None)


def test_repeated_request_rows_pair_with_every_judgment(spark):
    components = _experiment(
        spark, [("a", "d", 0.5, True), ("a", "d", 0.7, True), ("b", "d", 0.5, False)],
        [("a", 100, 0.1), ("a", 300, 0.3), ("b", 1, 0.1)], [("a", "base"), ("b", "cand")],
    )
    row = components.first()
    assert (row.baseline_evaluation_count, row.baseline_score_numerator) == (4, 2.4)
    assert (row.baseline_latency_ms_numerator, row.baseline_latency_ms_denominator) == (800, 4)
    assert row.baseline_estimated_cost_usd_numerator == 0.8


def test_comparison_sums_parts_before_dividing(spark):
    part = _experiment(spark, [("a", "d", 0.9, True), ("b", "d", 0.5, False)], [("a", 100, 0.1), ("b", 200, 0.2)], [("a", "base"), ("b", "cand")])
    row = marts.experiment_comparison(part.unionByName(part)).first()
    assert (row.baseline_evaluation_count, row.baseline_avg_score, row.candidate_avg_latency_ms) == (2, 0.9, 200.0)
