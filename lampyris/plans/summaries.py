"""Hourly and daily summaries of the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lampyris.functions.numeric import cost_units, exact_ratio, is_blank, or_unknown, usd
from lampyris.operators.rollup import (
    DistinctCount,
    Percentile,
    Rollup,
    known,
    mean,
    mean_exact,
    peak,
    rows,
    rows_where,
    total,
    total_cost,
    total_exact,
)

_OK = "status = 'success'"
_ERR = "status = 'error'"


def _request_rollup(keys: tuple[str, ...], names: tuple[str, ...], latency_peak: bool = True) -> Rollup:
    """Requests, outcomes, tokens, cost and latency under the given column names."""
    n, ok, err, prompt, completion, tokens, cost = names
    measures = [
        rows(n),
        rows_where(ok, _OK),
        rows_where(err, _ERR),
        total(prompt, "prompt_tokens"),
        total(completion, "completion_tokens"),
        total(tokens, "total_tokens"),
        total_cost(cost, "estimated_cost_usd"),
        mean("avg_latency_ms", "latency_ms", 2),
    ]
    if latency_peak:
        measures.append(peak("max_latency_ms", "latency_ms"))
    return Rollup(keys, tuple(measures), Percentile("p95_latency_ms", "latency_ms", 95))


def _period_names(period: str) -> tuple[str, ...]:
    stems = ("request_cnt", "success_cnt", "error_cnt", "prompt_token_cnt", "completion_token_cnt", "total_token_cnt", "estimated_cost_amt")
    return tuple(f"{stem}_{period}" for stem in stems)


FEATURE_DAILY = _request_rollup(
    ("date", "app_name", "feature_name", "model_name"),
    ("request_count", "success_count", "error_count", "prompt_tokens", "completion_tokens", "total_tokens", "estimated_cost_usd"),
)
FEATURE_HOURLY = _request_rollup(("date", "hour", "app_name", "feature_name", "model_name"), _period_names("1h"))
FEATURE_ENV_DAILY = _request_rollup(
    ("date", "app_name", "feature_name", "model_name", "environment"), _period_names("1d")
)
REGION_DAILY = _request_rollup(("date", "region", "environment", "app_name", "model_name"), _period_names("1d"))

TOOL_DAILY = Rollup(
    ("date", "agent_id", "tool_name", "tool_type"),
    (
        rows("tool_call_count"),
        rows_where("success_count", _OK),
        rows_where("error_count", _ERR),
        total("retry_count", "retry_count"),
        mean("avg_duration_ms", "duration_ms", 2),
        mean("avg_result_size", "result_size", 2),
        peak("max_result_size", "result_size"),
    ),
    Percentile("p95_duration_ms", "duration_ms", 95),
    columns=(
        "date", "agent_id", "tool_name", "tool_type", "tool_call_count", "success_count", "error_count",
        "retry_count", "avg_duration_ms", "p95_duration_ms", "avg_result_size", "max_result_size",
    ),
)

HANDOFF_DAILY = Rollup(
    ("date", "parent_agent_id", "child_agent_id", "handoff_type"),
    (
        rows("handoff_cnt_1d"),
        rows_where("success_cnt_1d", _OK),
        rows_where("error_cnt_1d", _ERR),
        rows_where("timeout_cnt_1d", "status = 'timeout'"),
        mean("avg_handoff_latency_ms", "handoff_latency_ms", 2),
    ),
    Percentile("p95_handoff_latency_ms", "handoff_latency_ms", 95),
)

RETRIEVAL_DAILY = Rollup(
    ("date", "app_name", "knowledge_base_id", "embedding_model", "retrieval_strategy"),
    (
        rows("retrieval_cnt_1d"),
        rows_where("success_cnt_1d", _OK),
        rows_where("error_cnt_1d", _ERR),
        rows_where("zero_result_cnt_1d", "returned_count = 0"),
        total("returned_cnt_1d", "returned_count"),
        total("hit_cnt_1d", "hit_count"),
        mean_exact("avg_similarity_score", "avg_similarity_score", 4),
        mean("avg_total_latency_ms", "total_latency_ms", 2),
        mean("avg_embedding_latency_ms", "embedding_latency_ms", 2),
        mean("avg_search_latency_ms", "search_latency_ms", 2),
    ),
    Percentile("p95_total_latency_ms", "total_latency_ms", 95),
    columns=(
        "date", "app_name", "knowledge_base_id", "embedding_model", "retrieval_strategy", "retrieval_cnt_1d",
        "success_cnt_1d", "error_cnt_1d", "zero_result_cnt_1d", "returned_cnt_1d", "hit_cnt_1d",
        "avg_similarity_score", "avg_total_latency_ms", "p95_total_latency_ms", "avg_embedding_latency_ms",
        "avg_search_latency_ms",
    ),
)

FEEDBACK_DAILY = Rollup(
    ("date", "app_name", "feature_name", "agent_id"),
    (
        rows("feedback_cnt_1d"),
        rows_where("thumbs_up_cnt_1d", "feedback_type = 'thumbs_up'"),
        rows_where("thumbs_down_cnt_1d", "feedback_type = 'thumbs_down'"),
        rows_where("regenerate_cnt_1d", "feedback_type = 'regenerate'"),
        rows_where("report_cnt_1d", "feedback_type = 'report'"),
        mean("avg_rating", "rating_value", 2),
    ),
    distinct=DistinctCount("rated_request_cnt_1d", "request_id"),
)

GUARDRAIL_DAILY = Rollup(
    ("date", "app_name", "rule_category", "action_taken"),
    (
        rows("check_cnt_1d"),
        rows_where("triggered_cnt_1d", "triggered"),
        rows_where("block_cnt_1d", "action_taken = 'block'"),
        rows_where("redact_cnt_1d", "action_taken = 'redact'"),
        rows_where("warn_cnt_1d", "action_taken = 'warn'"),
        mean("avg_guardrail_latency_ms", "guardrail_latency_ms", 2),
    ),
    distinct=DistinctCount("distinct_user_cnt_1d", "user_id"),
)

EVALUATION_DAILY = Rollup(
    ("date", "app_name", "feature_name", "evaluation_dimension", "evaluated_model_name"),
    (
        rows("evaluation_cnt_1d"),
        rows_where("pass_cnt_1d", "passed"),
        rows_where("fail_cnt_1d", "NOT passed"),
        mean_exact("avg_score", "score", 4),
        mean("avg_evaluation_latency_ms", "evaluation_latency_ms", 2),
    ),
    Percentile("p10_score", "score", 10, bin_width=0.0001),
    columns=(
        "date", "app_name", "feature_name", "evaluation_dimension", "evaluated_model_name", "evaluation_cnt_1d",
        "pass_cnt_1d", "fail_cnt_1d", "avg_score", "p10_score", "avg_evaluation_latency_ms",
    ),
)

_PROMPT_KEYS = ("date", "prompt_id", "prompt_version", "model_name")
PROMPT_REQUESTS = Rollup(
    _PROMPT_KEYS,
    (
        rows("request_cnt_1d"),
        rows_where("success_cnt_1d", _OK),
        rows_where("error_cnt_1d", _ERR),
        mean("avg_latency_ms", "latency_ms", 2),
        total("total_token_cnt_1d", "total_tokens"),
        total_cost("estimated_cost_amt_1d", "estimated_cost_usd"),
    ),
    Percentile("p95_latency_ms", "latency_ms", 95),
)


def feature_daily(requests: DataFrame) -> DataFrame:
    return FEATURE_DAILY.build(requests)


def with_hour(requests: DataFrame) -> DataFrame:
    return requests.withColumn("hour", F.hour("created_at"))


def feature_hourly(requests: DataFrame) -> DataFrame:
    return FEATURE_HOURLY.build(with_hour(requests))


def feature_env_daily(requests: DataFrame) -> DataFrame:
    return FEATURE_ENV_DAILY.build(requests)


def region_daily(requests: DataFrame) -> DataFrame:
    return REGION_DAILY.build(requests)


def tool_daily(tool_calls: DataFrame) -> DataFrame:
    return TOOL_DAILY.build(tool_calls)


def handoff_daily(handoffs: DataFrame) -> DataFrame:
    daily = HANDOFF_DAILY.build(handoffs)
    return daily.withColumn("p95_handoff_latency_ms", F.col("p95_handoff_latency_ms").cast("bigint"))


def retrieval_daily(retrievals: DataFrame) -> DataFrame:
    return RETRIEVAL_DAILY.build(retrievals)


def feedback_daily(feedback: DataFrame) -> DataFrame:
    return FEEDBACK_DAILY.build(feedback)


def guardrail_daily(checks: DataFrame) -> DataFrame:
    return GUARDRAIL_DAILY.build(checks)


def evaluation_daily(evaluations: DataFrame) -> DataFrame:
    return EVALUATION_DAILY.build(evaluations)


def feature_daily_from_hourly(hourly: DataFrame) -> DataFrame:
    """Daily roll-up of hourly rows: additive measures, maximum, weighted mean.

    A percentile cannot be derived from hourly percentiles, so the daily table
    that needs one is built from the facts.
    """
    return hourly.groupBy("date", "app_name", "feature_name", "model_name").agg(
        F.sum("request_cnt_1h").alias("request_count"),
        F.sum("success_cnt_1h").alias("success_count"),
        F.sum("error_cnt_1h").alias("error_count"),
        F.sum("prompt_token_cnt_1h").alias("prompt_tokens"),
        F.sum("completion_token_cnt_1h").alias("completion_tokens"),
        F.sum("total_token_cnt_1h").alias("total_tokens"),
        usd(F.sum(cost_units(F.col("estimated_cost_amt_1h")))).alias("estimated_cost_usd"),
        exact_ratio(
            F.sum(F.col("avg_latency_ms").cast("decimal(18,2)") * F.col("request_cnt_1h")), F.sum("request_cnt_1h"), 2
        ).alias("avg_latency_ms"),
        F.max("max_latency_ms").alias("max_latency_ms"),
    )


def is_positive() -> Column:
    """Feedback that counts its session as resolved."""
    rated = (F.col("feedback_type") == "rating") & (F.col("rating_value") >= 4)
    return (F.col("feedback_type") == "thumbs_up") | rated


def session_daily(requests: DataFrame, feedback: DataFrame) -> DataFrame:
    """Sessions per feature: turns, tokens, duration, and how many were resolved.

    Both sides are reduced to one row per session before they meet, so neither
    a busy session nor a session with much feedback widens the join.
    """
    session = ["date", "app_name", "feature_name", "session_id"]
    started = F.unix_micros("created_at")
    ended = started + F.col("latency_ms").cast("bigint") * 1000
    activity = (
        requests.select(*session, "total_tokens", started.alias("_started"), ended.alias("_ended"))
        .groupBy(*session)
        .agg(
            F.count(F.lit(1)).alias("turns"),
            F.sum("total_tokens").alias("tokens"),
            (F.max("_ended") - F.min("_started")).alias("_micros"),
        )
        # Hundredths of a millisecond, half up.
        .withColumn("duration", F.expr("(_micros + 5) div 10"))
    )
    resolved = feedback.where(is_positive()).select(*session).distinct().withColumn("resolved", F.lit(1))
    n = F.count(F.lit(1))
    return (
        activity.join(resolved, session, "left")
        .groupBy("date", "app_name", "feature_name")
        .agg(
            n.alias("session_cnt_1d"),
            F.round(F.sum("turns") / n, 2).alias("avg_turns_per_session"),
            F.round(F.sum("tokens") / F.count("tokens"), 2).alias("avg_tokens_per_session"),
            F.round(F.sum("duration") / F.count("duration") / 100, 2).alias("avg_duration_per_session_ms"),
            F.count("resolved").alias("resolved_session_cnt_1d"),
        )
    )


_AGENT_KEYS = ("date", "app_name", "agent_id", "agent_name", "task_type")


def _agent_rollup(keys: tuple[str, ...], names: dict[str, str]) -> Rollup:
    return Rollup(
        keys,
        (
            rows(names["runs"]),
            rows_where(names["ok"], _OK),
            rows_where(names["err"], _ERR),
            total(names["turns"], "turn_count"),
            total(names["calls"], "llm_call_count"),
            total(names["tools"], "tool_call_count"),
            total(names["retrievals"], "retrieval_count"),
            total(names["tokens"], "total_tokens"),
            total_cost(names["cost"], "estimated_cost_usd"),
            mean("avg_duration_ms", "duration_ms", 2),
            total(names["spans"], "_spans"),
            total(names["failed_spans"], "_failed_spans"),
            total(names["tool_spans"], "_tool_spans"),
            total(names["model_spans"], "_model_spans"),
        ),
        Percentile("p95_duration_ms", "duration_ms", 95),
        columns=(
            *keys, names["runs"], names["ok"], names["err"], names["turns"], names["calls"], names["tools"],
            names["retrievals"], names["tokens"], names["cost"], "avg_duration_ms", "p95_duration_ms",
            names["spans"], names["failed_spans"], names["tool_spans"], names["model_spans"],
        ),
    )


AGENT_DAILY = _agent_rollup(
    _AGENT_KEYS,
    {
        "runs": "run_count", "ok": "success_count", "err": "error_count", "turns": "turn_count",
        "calls": "llm_call_count", "tools": "tool_call_count", "retrievals": "retrieval_count",
        "tokens": "total_tokens", "cost": "estimated_cost_usd", "spans": "span_count",
        "failed_spans": "failed_span_count", "tool_spans": "tool_span_count", "model_spans": "llm_span_count",
    },
)
AGENT_TEAM_DAILY = _agent_rollup(
    ("date", "team_id", *_AGENT_KEYS[1:]),
    {
        "runs": "run_cnt_1d", "ok": "success_cnt_1d", "err": "error_cnt_1d", "turns": "turn_cnt_1d",
        "calls": "llm_call_cnt_1d", "tools": "tool_call_cnt_1d", "retrievals": "retrieval_cnt_1d",
        "tokens": "total_token_cnt_1d", "cost": "estimated_cost_amt_1d", "spans": "span_cnt_1d",
        "failed_spans": "failed_span_cnt_1d", "tool_spans": "tool_span_cnt_1d", "model_spans": "llm_span_cnt_1d",
    },
)


def runs_with_span_counts(runs: DataFrame, spans: DataFrame) -> DataFrame:
    """Each run row with the span counters of its (date, agent, run).

    Spans are counted per run before the join: a run with very many spans is
    combined on the map side and the join sees one row per run.
    """
    run_key = ["date", "agent_id", "run_id"]
    counters = spans.groupBy(*run_key).agg(
        F.count(F.lit(1)).alias("_spans"),
        F.count_if(F.col("status") == "error").alias("_failed_spans"),
        F.count_if(F.col("span_type") == "tool_call").alias("_tool_spans"),
        F.count_if(F.col("span_type") == "llm_call").alias("_model_spans"),
    )
    joined = runs.join(counters, run_key, "left")
    return joined.fillna(0, ["_spans", "_failed_spans", "_tool_spans", "_model_spans"])


def agent_daily(runs: DataFrame, spans: DataFrame) -> DataFrame:
    return AGENT_DAILY.build(runs_with_span_counts(runs, spans))


def with_team(rows_by_user: DataFrame, users: DataFrame) -> DataFrame:
    """Replace the user by the team the user belongs to, ``unknown`` if none.

    Callers reduce facts per user first, so a user with a large share of all
    rows is a few rows here; Spark broadcasts the dimension only when its
    measured size is under the threshold.
    """
    teams = users.select("user_id", "team_id")
    return rows_by_user.join(teams, "user_id", "left").withColumn("team_id", F.coalesce("team_id", F.lit("unknown")))


def agent_team_daily(runs: DataFrame, spans: DataFrame, users: DataFrame) -> DataFrame:
    partials = AGENT_TEAM_DAILY.partials(runs_with_span_counts(runs, spans), extra_keys=("user_id",))
    return AGENT_TEAM_DAILY.finish(with_team(partials, users))


_TEAM_REQUESTS = Rollup(
    ("date", "team_id", "app_name", "model_name"),
    (
        rows("request_cnt_1d"),
        total("total_token_cnt_1d", "total_tokens"),
        total_cost("estimated_cost_amt_1d", "estimated_cost_usd"),
    ),
)
_TEAM_RUNS = Rollup(
    ("date", "team_id", "app_name"),
    (rows("agent_run_cnt_1d"), total_cost("agent_cost_amt_1d", "estimated_cost_usd")),
)


def team_cost_daily(requests: DataFrame, users: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Model cost per team, with the team's agent cost repeated on each model row."""

    def per_team(rollup: Rollup, facts: DataFrame) -> DataFrame:
        return rollup.finish(with_team(rollup.partials(facts, extra_keys=("user_id",)), users))

    out = per_team(_TEAM_REQUESTS, requests)
    if runs is None:
        return out.withColumn("agent_run_cnt_1d", F.lit(0).cast("bigint")).withColumn(
            "agent_cost_amt_1d", F.lit(0.0)
        )
    joined = out.join(per_team(_TEAM_RUNS, runs), ["date", "team_id", "app_name"], "left")
    return joined.fillna({"agent_run_cnt_1d": 0, "agent_cost_amt_1d": 0.0}).select(
        *out.columns, "agent_run_cnt_1d", "agent_cost_amt_1d"
    )


def _with_missing(frame: DataFrame, **defaults) -> DataFrame:
    """Add columns the caller did not supply."""
    absent = {name: F.lit(value) for name, value in defaults.items() if name not in frame.columns}
    return frame.withColumns(absent) if absent else frame


def prompt_version_daily(requests: DataFrame, evaluations: DataFrame | None = None) -> DataFrame:
    """Requests per prompt version with attributed evaluations and conflicts.

    A request id seen under several prompt keys on one day is a conflict: it is
    counted on each key and its evaluations fall back to the evaluated version.
    """
    named = with_prompt_names(requests)
    request_key = ["date", "request_id"]
    # One row per request id: its keys are unique if the least and the greatest
    # agree; only ids with a conflict are looked at again.
    identified = named.where(~is_blank(F.col("request_id")))
    triple = F.struct(*_PROMPT_KEYS[1:])
    per_id = identified.groupBy(*request_key).agg(F.min(triple).alias("_least"), F.max(triple).alias("_greatest"))
    in_conflict = per_id.where("_least <> _greatest").select(*request_key)
    conflicts = (
        identified.join(in_conflict, request_key, "left_semi")
        .select(*request_key, *_PROMPT_KEYS[1:]).distinct()
        .groupBy(*_PROMPT_KEYS).agg(F.count(F.lit(1)).alias("metadata_conflict_cnt_1d"))
    )
    daily = PROMPT_REQUESTS.build(named)
    if evaluations is None:
        judged = daily.withColumns(
            {
                "evaluation_cnt_1d": F.lit(0).cast("bigint"),
                "pass_cnt_1d": F.lit(0).cast("bigint"),
                "fail_cnt_1d": F.lit(0).cast("bigint"),
                "evaluation_score_num_1d": F.lit(0.0),
                "evaluation_score_den_1d": F.lit(0).cast("bigint"),
            }
        )
    else:
        unique = per_id.where("_least = _greatest").select(*request_key, "_least.*")
        judged = daily.join(_evaluations_by_prompt(evaluations, unique), list(_PROMPT_KEYS), "left").fillna(
            {
                "evaluation_cnt_1d": 0,
                "pass_cnt_1d": 0,
                "fail_cnt_1d": 0,
                "evaluation_score_num_1d": 0.0,
                "evaluation_score_den_1d": 0,
            }
        )
    return _prompt_columns(judged.join(conflicts, list(_PROMPT_KEYS), "left").fillna({"metadata_conflict_cnt_1d": 0}))


def with_prompt_names(requests: DataFrame) -> DataFrame:
    """Requests whose prompt id, version and model are ``unknown`` where blank."""
    requests = _with_missing(requests, request_id="", prompt_id="", prompt_version="", model_name="")
    return requests.withColumns({c: or_unknown(F.col(c)) for c in _PROMPT_KEYS[1:]})


def prompt_summary(daily: DataFrame, counts: DataFrame | None) -> DataFrame:
    """The prompt version summary from requests per key and the sums of attributed evaluations and conflicts per key."""
    zeros = {
        "evaluation_cnt_1d": 0, "pass_cnt_1d": 0, "fail_cnt_1d": 0, "evaluation_score_num_1d": 0.0, "evaluation_score_den_1d": 0,
        "metadata_conflict_cnt_1d": 0,
    }
    if counts is None:
        return _prompt_columns(daily.withColumns({c: F.lit(v).cast("double" if isinstance(v, float) else "bigint") for c, v in zeros.items()}))
    counts = counts.withColumn("evaluation_score_num_1d", F.col("evaluation_score_num_1d").cast("double"))
    return _prompt_columns(daily.join(counts.select(*_PROMPT_KEYS, *zeros), list(_PROMPT_KEYS), "left").fillna(zeros))


def _prompt_columns(out: DataFrame) -> DataFrame:
    average = exact_ratio(F.col("evaluation_score_num_1d"), F.col("evaluation_score_den_1d"), 4)
    return out.withColumn("avg_evaluation_score", average).select(
        *_PROMPT_KEYS, "request_cnt_1d", "success_cnt_1d", "error_cnt_1d", "avg_latency_ms", "p95_latency_ms",
        "total_token_cnt_1d", "estimated_cost_amt_1d", "evaluation_cnt_1d", "pass_cnt_1d", "fail_cnt_1d",
        "evaluation_score_num_1d", "evaluation_score_den_1d", "avg_evaluation_score", "metadata_conflict_cnt_1d",
    )


_PROMPT_EVALUATIONS = Rollup(
    _PROMPT_KEYS,
    (
        rows("evaluation_cnt_1d"),
        rows_where("pass_cnt_1d", "passed"),
        rows_where("fail_cnt_1d", "NOT passed"),
        total_exact("evaluation_score_num_1d", "score", if_empty=0.0),
        known("evaluation_score_den_1d", "score"),
    ),
)


def _evaluations_by_prompt(evaluations: DataFrame, unique_requests: DataFrame) -> DataFrame:
    evaluations = _with_missing(
        evaluations, request_id="", evaluated_prompt_version="", evaluated_model_name="", score=None, passed=None
    )
    named = evaluations.select(
        "date",
        "request_id",
        or_unknown(F.col("evaluated_prompt_version")).alias("_version"),
        or_unknown(F.col("evaluated_model_name")).alias("_model"),
        F.col("score").cast("double").alias("score"),
        F.col("passed").cast("boolean").alias("passed"),
    )
    # One row per judged request and version: many judgments of one request
    # are combined before the join.
    partials = _PROMPT_EVALUATIONS.partials(named, extra_keys=("request_id", "_version", "_model"))
    attributed = (
        partials.join(unique_requests, ["date", "request_id"], "left")
        .withColumn("prompt_id", F.coalesce("prompt_id", F.lit("unknown")))
        .withColumn("prompt_version", F.coalesce("prompt_version", "_version"))
        .withColumn("model_name", F.coalesce("model_name", "_model"))
    )
    return _PROMPT_EVALUATIONS.finish(attributed)


PLATFORM_DAILY = Rollup(
    ("date", "component", "metric_name"), (peak("metric_value", "metric_value"), peak("threshold", "threshold"))
)


def with_breach(worst: DataFrame) -> DataFrame:
    """A value equal to the bound is no breach."""
    return worst.withColumn("is_breach", F.col("metric_value") > F.col("threshold"))


def platform_health_daily(observations: DataFrame) -> DataFrame:
    """Worst value per component, metric and day."""
    return with_breach(PLATFORM_DAILY.build(observations))
