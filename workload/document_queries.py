"""Queries of the document adapters and the streaming jobs."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lampyris.contracts import CONTRACTS
from lampyris.plans import backfill, facts, summaries
from lampyris.plans.adapters import generations, scores, traces, trajectories
from lampyris.streaming import jobs, joins
from lampyris.streaming.segments import Segments
from lampyris.streaming.upserts import UpsertTable, start_keyed_upsert
from workload import views
from workload.oracles import CTES, big, usd_sum, with_ctes
from workload.queries import ORACLES, QUERIES, register


def scratch(spark: SparkSession) -> str:
    """A fresh folder under the shared checkpoint folder; only a local session does without one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="spark-")
    return f"{shared.rstrip('/')}/work-{uuid.uuid4().hex}"


def _stored(frame: DataFrame) -> DataFrame:
    """The frame, computed once and kept under the shared folder."""
    path = f"{scratch(frame.sparkSession)}/rows"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


_MS = "date_trunc('millisecond', ts)"


def _generations(spark: SparkSession, sf_dir: str, only_labels: bool = False) -> DataFrame:
    docs = views.documents(spark, sf_dir, "generation")
    # Every tenth document is replayed.
    replayed = docs.unionByName(docs.where("event_id % 10 = 0")).drop("event_id")
    return generations.normalize(replayed, only_labels=only_labels)


# Milliseconds are cut off after a float product of seconds, as the data model
# defines them: 2.010 s is 2009 ms.
_GEN_MS = "cast(floor((cast(event_id % 5000 * 1000 as double) / 1000000) * 1000) as integer)"
_GEN = f"""
select event_id, concat('gen_', event_id) as request_id, {_MS} as created_at, cast({_MS} as date) as date,
  {_GEN_MS} as latency_ms, cast(event_id % 90 as integer) as prompt_tokens,
  cast(event_id % 40 as integer) as completion_tokens, cast(event_id % 90 + event_id % 40
    + case when event_id % 74 = 0 then 1 else 0 end as integer) as total_tokens, user_id, event_type,
  concat_ws(',', case when event_id % 11 = 0 then 'completeness:missing_region' end,
    case when event_id % 74 = 0 then 'consistency:token_total_mismatch' end,
    case when event_id % 5000 = 0 then 'validity:non_positive_latency' end,
    case when event_id % 53 = 0 then 'validity:unsupported_observation_type' end) as errors
from events"""
register(
    "adapter_generation_requests",
    lambda s, d: generations.requests(_generations(s, d)).select(
        "request_id", "trace_id", "span_id", "app_name", "feature_name", "user_id", "session_id", "provider", "model_name",
        "prompt_hash", "response_hash", "input_chars", "prompt_tokens", "completion_tokens", "total_tokens", "latency_ms", "status",
        "error_type", "http_status", "estimated_cost_usd", "estimated_cost_source", "mode", "created_at", "date",
    ),
    f"""select request_id, concat('trace_', user_id) as trace_id, request_id as span_id, concat('app_', event_id % 3) as app_name,
      concat('flow_', event_id % 5) as feature_name, concat('user_', user_id) as user_id, concat('session_', user_id % 7) as session_id,
      concat('p', user_id % 3) as provider, concat('model_', event_id % 4) as model_name,
      sha256(concat('question ', event_id % 100)) as prompt_hash,
      sha256(concat('{{"a":"x","b":', event_id % 3, '}}')) as response_hash,
      cast(length(concat('question ', event_id % 100)) as integer) as input_chars,
      prompt_tokens, completion_tokens, total_tokens, latency_ms, case when event_type = 'error' then 'error' else 'success' end as status,
      case when event_type = 'error' then 'generation_error' end as error_type,
      cast(case when event_type = 'error' then 500 else 200 end as integer) as http_status,
      case when event_id % 3 < 2 then cast(event_id % 1000 as double) / 10000 else 0.0::double end as estimated_cost_usd,
      case event_id % 3 when 0 then 'langfuse_cost_details' when 1 then 'metadata_estimate' else 'default_zero' end as estimated_cost_source,
      'replay' as mode, created_at, date
    from ({_GEN}) t where errors = ''""",
)
register(
    "adapter_generation_rejects",
    lambda s, d: generations.rejects(_generations(s, d, only_labels=True)).select("request_id", F.array_join("_dq_errors", ",").alias("errors")),
    f"select request_id, errors from ({_GEN}) t where errors <> ''",
)


def _scores(spark: SparkSession, sf_dir: str, only_labels: bool = False) -> DataFrame:
    return scores.normalize(scores.standalone(views.documents(spark, sf_dir, "score")), only_labels)


register(
    "adapter_score_feedback",
    lambda s, d: scores.feedback_actions(_scores(s, d)).select(
        "feedback_id", "request_id", "app_name", "feature_name", "feedback_type", "rating_value", "response_latency_ms", "mode",
        "created_at", "date",
    ),
    f"""select concat('score_', event_id) as feedback_id, concat('req_', event_id % 500) as request_id,
      concat('app_', user_id % 3) as app_name, 'f' as feature_name,
      case event_id % 6 when 0 then 'thumbs_up' else 'rating' end as feedback_type,
      cast(case when event_id % 6 = 1 then case event_id % 8 when 0 then 1 else event_id % 8 end end as integer) as rating_value,
      cast(1 as integer) as response_latency_ms, 'live' as mode, {_MS} as created_at, cast({_MS} as date) as date
    from events where event_id % 6 = 0 or (event_id % 6 = 1 and event_id % 8 <= 5)""",
)
register(
    "adapter_score_evaluations",
    lambda s, d: scores.evaluation_judgments(_scores(s, d)).select(
        "evaluation_id", "request_id", "evaluator_type", "evaluation_dimension", "score", "pass_threshold", "passed", "mode",
        "created_at", "date",
    ),
    f"""select concat('score_', event_id) as evaluation_id, concat('req_', event_id % 500) as request_id,
      case event_id % 6 when 2 then 'llm_judge' else 'classifier' end as evaluator_type,
      case event_id % 6 when 2 then 'faithfulness' else 'toxicity' end as evaluation_dimension, score, threshold as pass_threshold,
      score >= threshold as passed, 'offline' as mode, {_MS} as created_at, cast({_MS} as date) as date
    from (select *, case event_id % 6 when 2 then cast(event_id % 120 as double) / 100 else cast(event_id % 100 as double) / 100 end as score,
        case event_id % 6 when 2 then 0.7::double else 0.5::double end as threshold
      from events where event_id % 6 in (2, 5)) t where score <= 1""",
)
register(
    "adapter_score_rejects",
    lambda s, d: scores.rejects(_scores(s, d, only_labels=True)).select("score_id", F.array_join("_dq_errors", ",").alias("errors")),
    """select concat('score_', event_id) as score_id, case event_id % 6 when 1 then 'validity:invalid_rating_value'
        when 2 then 'validity:invalid_score_range' when 3 then 'validity:unknown_score_classification'
        else 'consistency:conflicting_score_classification' end as errors
      from events where event_id % 6 in (3, 4) or (event_id % 6 = 1 and event_id % 8 > 5) or (event_id % 6 = 2 and event_id % 120 > 100)""",
)


def _traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.documents(views.documents(spark, sf_dir, "trace"))


register(
    "adapter_trace_envelopes",
    lambda s, d: traces.envelopes(_traces(s, d)),
    f"""select concat('trace_', event_id) as trace_id, 'langfuse' as source_system, 'trace' as source_entity, 'flow' as trace_name,
      case when event_id % 4 = 0 then '' else concat('run_', event_id) end as run_id, event_id % 4 <> 0 as has_run_metadata,
      'app' as app_name, 'flow' as feature_name, concat('user_', user_id) as user_id, concat('s_', user_id % 7) as session_id,
      'dev' as environment, {_MS} as created_at, cast({_MS} as date) as date,
      cast(case when event_id % 13 = 0 then 5 else 4 end as integer) as observation_count from events""",
)
_LAST = "greatest(event_id % 5000, event_id % 700, event_id % 900 + 1)"
register(
    "adapter_trace_runs",
    lambda s, d: traces.accepted(traces.runs(_traces(s, d)), CONTRACTS["agent_run"]).select(
        "run_id", "trace_id", "agent_id", "user_id", "session_id", "task_type", "toolsets_used", "start_time", "end_time",
        "duration_ms", "status", "error_type", "llm_call_count", "tool_call_count", "retrieval_count", "total_tokens", "mode",
    ),
    f"""select concat('run_', event_id) as run_id, concat('trace_', event_id) as trace_id, concat('agent_', user_id % 5) as agent_id,
      concat('user_', user_id) as user_id, concat('s_', user_id % 7) as session_id, 't' as task_type,
      concat('["tool_', event_id % 6, '"]') as toolsets_used, {_MS} as start_time,
      {_MS} + to_milliseconds({_LAST}) as end_time,
      cast(floor((cast({_LAST} * 1000 as double) / 1000000) * 1000) as integer) as duration_ms,
      case when event_type = 'error' then 'error' else 'success' end as status,
      case when event_type = 'error' then 'generation_error' else '' end as error_type, cast(1 as integer) as llm_call_count,
      cast(1 as integer) as tool_call_count, cast(1 as integer) as retrieval_count, cast(event_id % 50 as integer) as total_tokens,
      'replay' as mode from events where event_id % 4 <> 0""",
)
register(
    "adapter_trace_spans",
    lambda s, d: traces.accepted(traces.spans(_traces(s, d)), CONTRACTS["agent_span"]).select(
        "span_id", "parent_span_id", "run_id", "trace_id", "span_name", "span_type", "span_order", "duration_ms", "status", "start_time"
    ),
    f"""select concat('span_', event_id) as span_id, cast(null as varchar) as parent_span_id,
      case when event_id % 4 = 0 then '' else concat('run_', event_id) end as run_id, concat('trace_', event_id) as trace_id,
      'root' as span_name, 'span' as span_type, cast(1 as integer) as span_order,
      cast(floor((cast(event_id % 5000 * 1000 as double) / 1000000) * 1000) as integer) as duration_ms, 'success' as status,
      {_MS} as start_time from events where event_id % 5000 > 0""",
)
register(
    "adapter_trace_tool_calls",
    lambda s, d: traces.accepted(traces.tool_calls(_traces(s, d)), CONTRACTS["tool_call"]).select(
        "tool_call_id", "span_id", "run_id", "tool_name", "tool_type", "arguments_json", "result_text", "duration_ms", "status", "error_type"
    ),
    """select concat('tool_', event_id) as tool_call_id, concat('span_', event_id) as span_id,
      case when event_id % 4 = 0 then '' else concat('run_', event_id) end as run_id, concat('tool_', event_id % 6) as tool_name,
      'function' as tool_type, concat('{"q":', event_id % 10, '}') as arguments_json, 'done' as result_text,
      cast(event_id % 700 as integer) as duration_ms, case when event_type = 'error' then 'error' else 'success' end as status,
      case when event_type = 'error' then 'generation_error' else '' end as error_type from events where event_id % 700 > 0""",
)
register(
    "adapter_trace_retrievals",
    lambda s, d: traces.accepted(traces.retrievals(_traces(s, d)), CONTRACTS["retrieval"]).select(
        "retrieval_id", "run_id", "user_id", "feature_name", "knowledge_base_id", "top_k", "returned_count", "hit_count",
        "max_similarity_score", "avg_similarity_score", "search_latency_ms", "total_latency_ms", "query_length",
    ),
    """select concat('ret_', event_id) as retrieval_id, case when event_id % 4 = 0 then '' else concat('run_', event_id) end as run_id,
      concat('user_', user_id) as user_id, 'flow' as feature_name, 'kb' as knowledge_base_id, cast(event_id % 4 as integer) as top_k,
      cast(2 as integer) as returned_count, cast(2 as integer) as hit_count, 0.5::double as max_similarity_score,
      0.375::double as avg_similarity_score, cast(event_id % 900 + 1 as integer) as search_latency_ms,
      cast(event_id % 900 + 1 as integer) as total_latency_ms, cast(1 as integer) as query_length
    from events where event_id % 4 > 0""",
)
register(
    "adapter_trace_scores",
    lambda s, d: scores.feedback_actions(traces.embedded_scores(_traces(s, d))).select(
        "feedback_id", "trace_id", "run_id", "session_id", "user_id", "app_name", "feature_name", "agent_id", "feedback_type", "mode"
    ),
    """select concat('sc_', event_id) as feedback_id, concat('trace_', event_id) as trace_id,
      case when event_id % 4 = 0 then '' else concat('run_', event_id) end as run_id, concat('s_', user_id % 7) as session_id,
      concat('user_', user_id) as user_id, 'app' as app_name, 'flow' as feature_name, concat('agent_', user_id % 5) as agent_id,
      'thumbs_up' as feedback_type, 'live' as mode from events""",
)
register(
    "adapter_trace_rejects",
    lambda s, d: traces.rejects(_stored(_traces(s, d))).select("_source_id", "_source_trace_id", F.array_join("_dq_errors", ",").alias("errors")),
    """select concat('odd_', event_id) as _source_id, concat('trace_', event_id) as _source_trace_id,
      'validity:unsupported_observation_type:event' as errors from events where event_id % 13 = 0
    union all select concat('span_', event_id), concat('trace_', event_id), 'validity:non_positive_duration' from events where event_id % 5000 = 0
    union all select concat('tool_', event_id), concat('trace_', event_id), 'validity:non_positive_duration' from events where event_id % 700 = 0
    union all select concat('ret_', event_id), concat('trace_', event_id), 'validity:non_positive_top_k' from events where event_id % 4 = 0""",
)


def _trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectories.documents(views.documents(spark, sf_dir, "trajectory"))


_TURNS = """select *, concat('conv_', conv_id, '_', block) as run_id,
  row_number() over (partition by conv_id, block order by turn) - 1 as i from (
  select conv_id, turn, turn // 8 as block, min(role) as role, min(text) as text from conversations group by conv_id, turn) c"""
_RUN_ID = "concat('{0}_', substring(sha256(concat_ws('|', {1})), 1, 32))"
register(
    "adapter_trajectory_runs",
    lambda s, d: trajectories.runs(_trajectories(s, d)).select(
        "run_id", "trace_id", "input_text_hash", "output_text_hash", "duration_ms", "status", "turn_count", "llm_call_count", "toolsets_used"
    ),
    f"""select run_id, {_RUN_ID.format('trace', "concat(chr(34), run_id, chr(34))")} as trace_id,
      sha256(coalesce(arg_min(text, i) filter (role = 'user'), '')) as input_text_hash,
      sha256(coalesce(arg_max(text, i) filter (role = 'assistant'), '')) as output_text_hash,
      cast((count(*) filter (role = 'assistant') + 1) * 100 as integer) as duration_ms,
      case when block % 2 = 0 then 'success' else 'error' end as status,
      cast(count(*) filter (role = 'user') as integer) as turn_count,
      cast(count(*) filter (role = 'assistant') as integer) as llm_call_count, '[]' as toolsets_used
    from ({_TURNS}) t group by run_id, block""",
)
register(
    "adapter_trajectory_spans",
    lambda s, d: trajectories.spans(_trajectories(s, d)).select(
        "span_id", "run_id", "span_type", "span_order", "output_size", "start_time", "status"
    ),
    f"""select {_RUN_ID.format('span', "concat(chr(34), run_id, chr(34)), cast(i as varchar), concat(chr(34), 'llm_call', chr(34))")} as span_id,
      run_id, 'llm_call' as span_type, cast(n as integer) as span_order, cast(length(text) as integer) as output_size,
      timestamp '2026-01-15 10:30:00' + to_milliseconds(case when i = 0 then 0 else n * 100 end) as start_time, 'success' as status
    from (select *, count(*) filter (role = 'assistant') over (partition by run_id order by i) as n from ({_TURNS}) t) u
    where role = 'assistant'""",
)
register(
    "adapter_trajectory_tool_calls",
    lambda s, d: trajectories.tool_calls(trajectories.documents(views.documents(s, d, "tool_trajectory"))).select(
        "tool_call_id", "span_id", "run_id", "tool_name", "tool_type", "arguments_json", "result_text", "result_size", "status", "error_type",
        "created_at", "date",
    ),
    f"""select case when j = 0 then concat('call_', event_id) else {_RUN_ID.format('tool_call', "concat(chr(34), run_id, chr(34)), '1', '1'")} end as tool_call_id,
      {_RUN_ID.format('span', "concat(chr(34), run_id, chr(34)), '1', cast(j as varchar), concat(chr(34), 'tool_call', chr(34))")} as span_id,
      run_id, concat('tool_', event_id % case when j = 0 then 6 else 4 end) as tool_name, 'function' as tool_type,
      case when j = 0 then concat('{{"n": ', event_id % 10, '}}') else 'raw' end as arguments_json,
      case when j = 1 then '' when event_id % 7 = 0 then 'Error: late' else 'fine' end as result_text,
      cast(case when j = 1 then 0 when event_id % 7 = 0 then 11 else 4 end as integer) as result_size,
      case when j = 0 and event_id % 7 = 0 then 'error' else 'success' end as status,
      case when j = 0 and event_id % 7 = 0 then 'tool_error' end as error_type,
      date_trunc('second', ts) + interval 100 millisecond as created_at, cast(date_trunc('second', ts) + interval 100 millisecond as date) as date
    from (select event_id, ts, concat('visit_', event_id) as run_id, unnest([0, 1]) as j from events) t""",
)

# --- streams -----------------------------------------------------------------


# Requests made from the event stream alone.
_STREAMED = """
  concat('req_', event_id) as request_id, event_type as app_name, concat('f_', user_id % 5) as feature_name,
  concat('model_', event_id % 4) as model_name, cast(event_id % 90 as int) as prompt_tokens,
  cast(event_id % 40 as int) as completion_tokens, cast(event_id % 90 + event_id % 40 as int) as total_tokens,
  cast(event_id % 701 as int) as latency_ms, case when event_type = 'error' then 'error' else 'success' end as status,
  cast(event_id % 1000 as double) / 10000 as estimated_cost_usd, 'live' as mode, ts as created_at, cast(ts as date) as date"""


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = views.table(spark, sf_dir, "events").schema
    source = spark.readStream.schema(schema).format("parquet").load(f"{sf_dir}/events.parquet*")
    return facts.valid(source.selectExpr(*_split(_STREAMED)), "llm_request", fill_nulls=True, null_fails=True)


def _split(columns: str) -> list[str]:
    """Top-level comma parts of a select list."""
    parts, depth, start = [], 0, 0
    for i, c in enumerate(columns):
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            parts.append(columns[start:i])
            start = i + 1
    return [*parts, columns[start:]]


def _hourly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch(spark)
    jobs.start_hourly(_stream(spark, sf_dir), f"{where}/hourly", f"{where}/check").awaitTermination()
    return jobs.read_appended(spark, f"{where}/hourly").drop("_batch")


def _daily_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch(spark)
    query = jobs.start_rollup(
        _stream(spark, sf_dir), summaries.FEATURE_DAILY, f"{where}/parts", f"{where}/daily", f"{where}/check"
    )
    query.awaitTermination()
    return spark.read.parquet(f"{where}/daily")


_VALID = f"(select {_STREAMED} from events where event_id % 701 > 0)"


def _streamed_summary(keys: str, names: tuple[str, ...], extra: str = "") -> str:
    from workload.oracles import mean

    n, ok, err, p, c, t, cost = names
    return f"""select {keys}, count(*) as {n}, count(*) filter (status = 'success') as {ok}, count(*) filter (status = 'error') as {err},
      {big('sum(prompt_tokens)')} as {p}, {big('sum(completion_tokens)')} as {c}, {big('sum(total_tokens)')} as {t}, {usd_sum()} as {cost},
      {mean('latency_ms')} as avg_latency_ms, max(latency_ms) as max_latency_ms, quantile_disc(latency_ms, 0.95) as p95_latency_ms
    from {_VALID} t {extra} group by all"""


_H = tuple(f"{s}_1h" for s in "request_cnt success_cnt error_cnt prompt_token_cnt completion_token_cnt total_token_cnt estimated_cost_amt".split())
_D = ("request_count", "success_count", "error_count", "prompt_tokens", "completion_tokens", "total_tokens", "estimated_cost_usd")
register(
    "stream_feature_hourly",
    _hourly_stream,
    _streamed_summary(
        "date, cast(extract(hour from created_at) as int) as hour, app_name, feature_name, model_name", _H,
        # Only hours the watermark has passed are closed.
        f"where date_trunc('hour', created_at) + interval 1 hour <= (select max(created_at) from {_VALID} m) - interval 5 second",
    ),
)
register("stream_feature_daily", _daily_stream, _streamed_summary("date, app_name, feature_name, model_name", _D))

# --- streams of other facts, rows without a date, upserts and backfills ------------

_STREAMED_FACTS = {
    "feedback": """
  concat('fb_', event_id) as feedback_id, concat('req_', event_id % 977) as request_id, concat('s_', user_id) as session_id,
  concat('user_', user_id) as user_id, event_type as app_name, concat('f_', user_id % 3) as feature_name, concat('agent_', event_id % 2) as agent_id,
  case cast(event_id % 6 as int) when 0 then 'thumbs_up' when 1 then 'thumbs_down' when 2 then 'rating' when 3 then 'regenerate' when 4 then 'edit' else 'report' end as feedback_type,
  case when event_id % 6 = 2 then cast(event_id % 5 + 1 as int) else null end as rating_value, 1 as response_latency_ms,
  'live' as mode, ts as created_at, cast(ts as date) as date""",
    "guardrail": """
  concat('gr_', event_id) as guardrail_event_id, concat('user_', user_id) as user_id, event_type as app_name, 'pre_request' as guardrail_stage,
  concat('rule_', event_id % 3) as rule_name, case when event_id % 2 = 0 then 'toxicity' else 'topic_block' end as rule_category,
  event_id % 5 = 0 as triggered, case when event_id % 5 = 0 then 'block' else 'pass' end as action_taken, 'low' as severity,
  cast(event_id % 250 + 1 as int) as guardrail_latency_ms, 'live' as mode, ts as created_at, cast(ts as date) as date""",
}


def _other_stream(spark: SparkSession, sf_dir: str, columns: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = views.table(spark, sf_dir, "events").schema
    source = spark.readStream.schema(schema).format("parquet").load(f"{sf_dir}/events.parquet*")
    return source.selectExpr(*_split(columns))


def _rolled(stream: DataFrame, rollup) -> DataFrame:
    where = scratch(stream.sparkSession)
    jobs.start_rollup(stream, rollup, f"{where}/parts", f"{where}/daily", f"{where}/check").awaitTermination()
    return stream.sparkSession.read.parquet(f"{where}/daily")


def _mean(column: str) -> str:
    from workload.oracles import mean

    return mean(column)


register(
    "stream_feedback_daily",
    lambda s, d: _rolled(facts.valid(_other_stream(s, d, _STREAMED_FACTS["feedback"]), "feedback", True, True), summaries.FEEDBACK_DAILY),
    f"""select date, app_name, feature_name, agent_id, count(*) as feedback_cnt_1d, count(*) filter (feedback_type = 'thumbs_up') as thumbs_up_cnt_1d,
      count(*) filter (feedback_type = 'thumbs_down') as thumbs_down_cnt_1d, count(*) filter (feedback_type = 'regenerate') as regenerate_cnt_1d,
      count(*) filter (feedback_type = 'report') as report_cnt_1d, {_mean('rating_value')} as avg_rating, count(distinct request_id) as rated_request_cnt_1d
    from (select {_STREAMED_FACTS['feedback']} from events) t where rating_value is null or rating_value between 1 and 5 group by all""",
)
register(
    "stream_guardrail_daily",
    lambda s, d: _rolled(facts.valid(_other_stream(s, d, _STREAMED_FACTS["guardrail"]), "guardrail", True, True), summaries.GUARDRAIL_DAILY),
    f"""select date, app_name, rule_category, action_taken, count(*) as check_cnt_1d, count(*) filter (triggered) as triggered_cnt_1d,
      count(*) filter (action_taken = 'block') as block_cnt_1d, count(*) filter (action_taken = 'redact') as redact_cnt_1d,
      count(*) filter (action_taken = 'warn') as warn_cnt_1d, {_mean('guardrail_latency_ms')} as avg_guardrail_latency_ms,
      count(distinct user_id) as distinct_user_cnt_1d from (select {_STREAMED_FACTS['guardrail']} from events) t group by all""",
)
_UNDATED = _STREAMED.replace("cast(ts as date) as date", "case when event_id % 9 = 0 then null else cast(ts as date) end as date")
register(
    "stream_feature_daily_undated",
    lambda s, d: _rolled(facts.typed(_other_stream(s, d, _UNDATED), "llm_request", True), summaries.FEATURE_DAILY),
    _streamed_summary("date, app_name, feature_name, model_name", _D).replace(_VALID, f"(select {_UNDATED} from events)"),
)
_CHANGES = "concat('user_', user_id) as user_id, event_id as version, event_type as last_type, cast(ts as date) as date"


def _upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last change of each user; a user's date moves from change to change."""
    where = scratch(spark)
    jobs.start_upsert(_other_stream(spark, sf_dir, _CHANGES), f"{where}/changes", f"{where}/check").awaitTermination()
    for _ in range(2):
        jobs.compact(spark, f"{where}/changes", f"{where}/now", ["user_id"], ["version"])
    return spark.read.parquet(f"{where}/now")


register(
    "stream_upsert_users", _upserted,
    f"""select user_id, max(version) as version, arg_max(last_type, version) as last_type, arg_max(date, version) as date
    from (select {_CHANGES} from events) t group by user_id""",
)


# --- several micro-batches: merges, repeats, late conflicts, late feedback ------------------------

_SLICES = 5


def _sliced_events(spark: SparkSession, sf_dir: str, where: str) -> DataFrame:
    """The events as a stream of one file per batch, in order of event_id."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = views.table(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0] or 0
    for i in range(_SLICES):
        events.where(F.expr(f"event_id * {_SLICES} div {last + 1} = {i}")).coalesce(1).write.parquet(f"{where}/events/slice-{i}")
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
    return source.parquet(f"{where}/events")


def _typed(events: DataFrame, columns: str, fact: str) -> DataFrame:
    return facts.typed(events.selectExpr(*_split(columns)), fact, True)


def _daily_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily summary over several batches, with the last of them added once more as after a failure."""
    where = scratch(spark)
    valid = facts.valid(_sliced_events(spark, sf_dir, where).selectExpr(*_split(_STREAMED)), "llm_request", fill_nulls=True, null_fails=True)
    rollup = summaries.FEATURE_DAILY
    jobs.start_rollup(valid, rollup, f"{where}/parts", f"{where}/daily", f"{where}/check").awaitTermination()
    again = spark.read.parquet(f"{where}/events/slice-{_SLICES - 1}")
    repeated = facts.valid(again.selectExpr(*_split(_STREAMED)), "llm_request", fill_nulls=True, null_fails=True)
    store = Segments(spark, f"{where}/parts")
    store.add(_SLICES - 1, rollup.state(repeated), rollup.merge)
    return rollup.result(store.read())


register("stream_feature_daily_batches", _daily_in_batches, _streamed_summary("date, app_name, feature_name, model_name", _D))

# Requests come back under other prompt versions and are judged before and after; days follow from the request, so they meet.
_PROMPTED = """
  concat('req_', event_id % 3001) as request_id, concat('p_', event_id % 3001 % 4) as prompt_id,
  case when event_id % 3001 % 7 = 0 then concat('v', event_id % 3) else 'v1' end as prompt_version, concat('m_', event_id % 3001 % 2) as model_name,
  cast(event_id % 90 as int) as total_tokens, cast(event_id % 701 + 1 as int) as latency_ms,
  case when event_type = 'error' then 'error' else 'success' end as status, cast(event_id % 1000 as double) / 10000 as estimated_cost_usd,
  cast(date_add(DATE '2026-01-01', cast(event_id % 3001 % 5 as int)) as date) as date"""
_JUDGED = """
  concat('ev_', event_id) as evaluation_id, concat('req_', event_id * 7 % 3500) as request_id, cast(event_id % 100 as double) / 100 as score, event_id % 4 = 0 as passed,
  concat('v', event_id % 3) as evaluated_prompt_version, 'm_1' as evaluated_model_name,
  cast(date_add(DATE '2026-01-01', cast(event_id * 7 % 3500 % 3001 % 5 as int)) as date) as date"""
_TURNS_OF = """
  concat('req_', event_id) as request_id, event_type as app_name, concat('f_', user_id % 3) as feature_name, concat('s_', event_id % 1511) as session_id,
  cast(event_id % 90 as int) as total_tokens, cast(event_id % 701 + 1 as int) as latency_ms, ts as created_at,
  cast(date_add(DATE '2026-01-01', cast(event_id % 3 as int)) as date) as date"""
_PRAISED = """
  concat('fb_', event_id) as feedback_id, event_type as app_name, concat('f_', user_id % 3) as feature_name, concat('s_', event_id * 5 % 1511) as session_id,
  'rating' as feedback_type, cast(event_id % 5 + 1 as int) as rating_value, cast(date_add(DATE '2026-01-01', cast(event_id * 5 % 3 as int)) as date) as date"""


def _prompt_versions_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch(spark)
    requests = _typed(_sliced_events(spark, sf_dir, where), _PROMPTED, "llm_request")
    source = spark.readStream.schema(views.table(spark, sf_dir, "events").schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
    judged = _typed(source.parquet(f"{where}/events").where("event_id % 3 = 0"), _JUDGED, "evaluation")
    for query in joins.start_prompt_versions(requests, judged, f"{where}/stores", f"{where}/summary", f"{where}/check"):
        query.awaitTermination()
    return spark.read.parquet(f"{where}/summary")


def _sessions_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch(spark)
    events = _sliced_events(spark, sf_dir, where)
    query = joins.start_sessions(_typed(events, _TURNS_OF, "llm_request"), _typed(events.where("event_id % 2 = 0"), _PRAISED, "feedback"), f"{where}/sums", f"{where}/summary", f"{where}/check")
    query.awaitTermination()
    return spark.read.parquet(f"{where}/summary")


def _by_duckdb(columns: str, condition: str = "true") -> str:
    """The same rows for the oracle."""
    given = re.sub(r"cast\(date_add\(DATE '2026-01-01', cast\((.*?) as int\)\) as date\)", r"DATE '2026-01-01' + cast(\1 as int)", columns)
    return f"(select {given} from events where {condition})"


register(
    "stream_prompt_version_daily", _prompt_versions_in_batches,
    CTES["w_prompt_daily"].replace("f_llm_request", f"{_by_duckdb(_PROMPTED)} asked")
    .replace("f_evaluation e", f"(select *, cast(round(score * 100) as bigint) as score_pct from {_by_duckdb(_JUDGED, 'event_id % 3 = 0')} judged) e"),
)
register(
    "stream_session_daily", _sessions_in_batches,
    CTES["w_session_daily"].replace("f_llm_request", f"{_by_duckdb(_TURNS_OF)} asked").replace("f_feedback", f"{_by_duckdb(_PRAISED, 'event_id % 2 = 0')} told"),
)


def _upserted_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last change of each user from bases and deltas: compacted after every second batch, deltas left beside the bases."""
    where = scratch(spark)
    table = UpsertTable(spark, f"{where}/users", ["user_id"], ["version"], buckets=8)
    changes = _sliced_events(spark, sf_dir, where).selectExpr(*_split(_CHANGES))
    start_keyed_upsert(changes, table, f"{where}/check", compact_every=2).awaitTermination()
    return table.current().drop("_batch")


register("stream_upsert_merge_on_read", _upserted_in_batches)
ORACLES["stream_upsert_merge_on_read"] = ORACLES["stream_upsert_users"]


def _backfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests as JSON lines, loaded, and the summary that the load stores."""
    where = scratch(spark)
    # Gzip files are read whole, so they stay small.
    options = {"ignoreNullFields": "false", "compression": "gzip", "maxRecordsPerFile": 50_000}
    views.view(spark, sf_dir, "llm_request").write.options(**options).json(f"{where}/raw")
    backfill.backfill_requests(spark, f"{where}/raw", f"{where}/warehouse")
    return spark.read.parquet(f"{where}/warehouse/feature_daily")


register("backfill_feature_daily", _backfilled)
ORACLES["backfill_feature_daily"] = ORACLES["summary_feature_daily"]
__all__ = ["ORACLES", "QUERIES", "with_ctes"]
