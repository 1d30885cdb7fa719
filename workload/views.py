"""Telemetry-shaped views over the given tables.

The given tables carry no telemetry, so every raw fact is derived from them by
one SQL text that Spark and DuckDB both accept.  The views read whole tables
and contain rows that break the quality rules.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

_LINES = "lineitem l join orders o on l.l_orderkey = o.o_orderkey join customer c on o.o_custkey = c.c_custkey"
_ORDERS = "orders o join customer c on o.o_custkey = c.c_custkey"
#: The same join for Spark: orders meet their customers first, so lines are shuffled once, by their order, and not again by customer.
_LINES_LAST = f"lineitem l join ({_ORDERS}) on l.l_orderkey = o.o_orderkey"


#: Lines of a task that groups the facts of traces: their nodes, some KB for each line, are sorted in its memory.
TASK_LINES = 150_000


def _shared(key: str, none: str, tasks: str = "") -> tuple[str, str]:
    """Lines and orders for Spark where a query reads several facts of them, dealt out by `key` of the order (as `l_key` and `o_key`; `none` for an order without one).

    The one-row generators end the filters and column lists of a fact, so all facts read the same two shuffles, and their rows of a key
    stand together for what groups by it.
    """
    orders = f"""(select o_key, inline(array(struct(o_orderkey, o_orderkey as l_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
      o_orderpriority, c_mktsegment, c_nationkey))) from
      (select /*+ repartition({tasks}o_key) */ * from (select *, coalesce({key.format("o_orderkey")}, {none}) as o_key from {_ORDERS})))"""
    lines = f"""(select l_key, inline(array(struct(l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus))) from
      (select /*+ repartition({tasks}l_key) */ * from (select *, {key.format("l_orderkey")} as l_key from lineitem where l_orderkey is not null)))
      join {orders} on l_key = o_key and o_orderkey is not null"""
    return lines, orders


_TRACE = "concat('trace_', {})"
VIEWS: dict[str, str] = {
    "llm_request": f"""
select v.*, prompt_tokens + completion_tokens as total_tokens,
  cast(cast(prompt_tokens * 14 + completion_tokens * 28 as bigint) * 1000 + latency_ms % 991 as double) / 100000000000 as estimated_cost_usd
from (
  select concat('req_', l_orderkey, '_', l_linenumber) as request_id,
    concat('trace_', l_orderkey) as trace_id,
    concat('run_', l_orderkey) as run_id,
    concat('user_', o_custkey) as user_id,
    concat('session_', o_custkey) as session_id,
    c_mktsegment as app_name,
    o_orderpriority as feature_name,
    case when l_partkey % 97 = 0 then '' else concat('prompt_', l_partkey % 50) end as prompt_id,
    concat('v', l_suppkey % 3 + 1) as prompt_version,
    concat('model_', l_suppkey % 4) as model_name,
    cast(l_quantity as int) * 20 as prompt_tokens,
    case when l_returnflag = 'R' and l_linestatus = 'F' then 0
         else cast(l_quantity as int) * (l_linenumber + 5) end as completion_tokens,
    cast(l_suppkey * 37 % 4800 + case when l_partkey % 211 = 0 then -4800 else 200 end as int) as latency_ms,
    case when l_returnflag = 'R' and l_linestatus = 'F' then 'error' else 'success' end as status,
    'mock' as mode,
    concat('region_', c_nationkey % 3) as region,
    case when l_orderkey % 10 = 0 then 'prod' else 'dev' end as environment,
    o_orderdate + l_linenumber * INTERVAL '4000' SECOND as created_at,
    cast(o_orderdate as date) as date
  from {_LINES}) v""",
    "agent_run": f"""
select v.*, cast(cast(total_tokens as bigint) * 28000 + duration_ms % 991 as double) / 100000000000 as estimated_cost_usd
from (
  select concat('run_', o_orderkey) as run_id,
    concat('trace_', o_orderkey) as trace_id,
    concat('agent_', o_custkey % 20) as agent_id,
    concat('agent_name_', o_custkey % 20) as agent_name,
    o_orderpriority as task_type,
    c_mktsegment as app_name,
    concat('user_', o_custkey) as user_id,
    concat('session_', o_custkey) as session_id,
    cast(floor(o_totalprice) as int) % 60000 + 1 as duration_ms,
    case when o_orderstatus = 'F' then 'error' else 'success' end as status,
    cast(o_orderkey % 4 as int) + 1 as turn_count,
    cast(floor(o_totalprice) as int) % 5000 as total_tokens,
    cast(o_orderkey % 5 as int) as llm_call_count,
    cast(o_orderkey % 3 as int) as tool_call_count,
    cast(o_orderkey % 2 as int) as retrieval_count,
    'mock' as mode, 'dev' as environment,
    o_orderdate as start_time,
    o_orderdate as created_at,
    cast(o_orderdate as date) as date
  from {_ORDERS}) v""",
    "agent_span": f"""
select concat('span_', l_orderkey, '_', l_linenumber) as span_id,
  concat('run_', l_orderkey) as run_id,
  concat('trace_', l_orderkey) as trace_id,
  concat('agent_', o_custkey % 20) as agent_id,
  concat('step_', l_linenumber) as span_name,
  case l_linenumber % 3 when 0 then 'tool_call' when 1 then 'llm_call' else 'planning' end as span_type,
  l_linenumber as span_order,
  cast(l_suppkey * 53 % 9000 as int) as duration_ms,
  case when l_returnflag = 'R' then 'error' else 'success' end as status,
  'mock' as mode, 'dev' as environment,
  o_orderdate as start_time,
  o_orderdate as created_at,
  cast(o_orderdate as date) as date
from {_LINES}""",
    "tool_call": f"""
select concat('tc_', l_orderkey, '_', l_linenumber) as tool_call_id,
  concat('span_', l_orderkey, '_', l_linenumber) as span_id,
  concat('run_', l_orderkey) as run_id,
  concat('trace_', l_orderkey) as trace_id,
  concat('agent_', o_custkey % 20) as agent_id,
  concat('tool_', l_partkey % 7) as tool_name,
  'function' as tool_type,
  cast(l_partkey % 1000 as int) as result_size,
  cast(l_suppkey * 53 % 9000 as int) as duration_ms,
  case when l_returnflag = 'R' then 'error' else 'success' end as status,
  cast(l_partkey % 3 as int) as retry_count,
  'mock' as mode, 'dev' as environment,
  o_orderdate as created_at,
  cast(o_orderdate as date) as date
from {_LINES}""",
    "retrieval": f"""
select v.*, cast(avg_similarity_pct as double) / 100 as avg_similarity_score
from (
  select concat('ret_', l_orderkey, '_', l_linenumber) as retrieval_id,
    concat('trace_', l_orderkey) as trace_id,
    concat('run_', l_orderkey) as run_id,
    concat('req_', l_orderkey, '_', l_linenumber) as request_id,
    concat('user_', o_custkey) as user_id,
    o_orderpriority as feature_name,
    case when l_partkey % 17 = 0 then 'error' else 'success' end as status,
    cast(l_partkey % 101 as int) as avg_similarity_pct,
    cast(l_suppkey * 7 % 400 as int) as embedding_latency_ms,
    cast(l_suppkey * 34 % 2600 as int) as search_latency_ms,
    c_mktsegment as app_name,
    concat('kb_', l_partkey % 3) as knowledge_base_id,
    concat('Base ', l_partkey % 3) as knowledge_base_name,
    concat('emb_', l_suppkey % 2) as embedding_model,
    case when l_linestatus = 'F' then 'vector' else 'hybrid' end as retrieval_strategy,
    10 as top_k,
    cast(l_partkey % 11 as int) as returned_count,
    cast(l_suppkey % 11 as int) as hit_count,
    cast(l_suppkey * 41 % 3000 as int) as total_latency_ms,
    'mock' as mode, 'dev' as environment,
    o_orderdate as created_at,
    cast(o_orderdate as date) as date
  from {_LINES}) v""",
    "feedback": f"""
select concat('fb_', o_orderkey) as feedback_id,
  concat('req_', o_orderkey, '_1') as request_id,
  concat('session_', o_custkey) as session_id,
  concat('user_', o_custkey) as user_id,
  c_mktsegment as app_name,
  o_orderpriority as feature_name,
  concat('agent_', o_custkey % 20) as agent_id,
  case cast(o_orderkey % 7 as int) when 0 then 'thumbs_up' when 1 then 'thumbs_down' when 2 then 'rating'
    when 3 then 'regenerate' when 4 then 'edit' when 5 then 'report' else 'other' end as feedback_type,
  case when o_orderkey % 7 = 2 then cast(o_orderkey % 6 as int) else null end as rating_value,
  1 as response_latency_ms,
  'mock' as mode, 'dev' as environment,
  o_orderdate as created_at,
  cast(o_orderdate as date) as date
from {_ORDERS}""",
    "guardrail": f"""
select concat('gr_', l_orderkey, '_', l_linenumber) as guardrail_event_id,
  concat('user_', o_custkey) as user_id,
  c_mktsegment as app_name,
  'pre_request' as guardrail_stage,
  concat('rule_', l_linenumber % 5) as rule_name,
  case l_linenumber % 5 when 0 then 'content_filter' when 1 then 'pii_detection' when 2 then 'toxicity'
    when 3 then 'topic_block' else 'length_limit' end as rule_category,
  l_partkey % 6 = 0 as triggered,
  case when l_partkey % 6 = 0 then case cast(l_suppkey % 4 as int) when 0 then 'warn' when 1 then 'block'
    when 2 then 'redact' else 'override' end else 'pass' end as action_taken,
  case cast(l_partkey % 4 as int) when 0 then 'low' when 1 then 'medium' when 2 then 'high' else 'critical' end as severity,
  case when l_partkey % 83 = 0 then null else cast(l_suppkey % 300 as int) end as guardrail_latency_ms,
  'mock' as mode, 'dev' as environment,
  o_orderdate as created_at,
  cast(o_orderdate as date) as date
from {_LINES}""",
    "evaluation": f"""
select v.*, cast(score_pct as double) / 100 as score
from (
  select concat('eval_', l_orderkey, '_', l_linenumber) as evaluation_id,
    concat('req_', l_orderkey, '_', l_linenumber) as request_id,
    c_mktsegment as app_name,
    o_orderpriority as feature_name,
    'llm_judge' as evaluator_type,
    case cast(l_partkey % 5 as int) when 0 then 'relevance' when 1 then 'faithfulness' when 2 then 'coherence'
      when 3 then 'toxicity' else 'hallucination' end as evaluation_dimension,
    cast(l_suppkey * 13 % 2500 + 1 as int) as evaluation_latency_ms,
    cast(l_partkey % 105 as int) as score_pct,
    cast(0.6 as double) as pass_threshold,
    l_partkey % 105 >= 60 as passed,
    concat('model_', l_suppkey % 4) as evaluated_model_name,
    concat('v', l_suppkey % 3 + 1) as evaluated_prompt_version,
    'mock' as mode, 'dev' as environment,
    o_orderdate as created_at,
    cast(o_orderdate as date) as date
  from {_LINES}) v""",
    "handoff": f"""
select concat('ho_', o_orderkey) as orchestration_id,
  concat('trace_', o_orderkey) as trace_id,
  concat('run_', o_orderkey) as parent_run_id,
  concat('run_', o_orderkey + 1) as child_run_id,
  concat('agent_', o_custkey % 20) as parent_agent_id,
  concat('agent_', case when o_orderkey % 50 = 0 then o_custkey % 20
    else (o_custkey % 20 + 1 + o_orderkey % 19) % 20 end) as child_agent_id,
  case cast(o_orderkey % 4 as int) when 0 then 'delegate' when 1 then 'callback' when 2 then 'broadcast'
    else 'sequential' end as handoff_type,
  1 as payload_size,
  cast(floor(o_totalprice) as int) % 5000 as handoff_latency_ms,
  case o_orderstatus when 'F' then 'error' when 'P' then 'timeout' else 'success' end as status,
  o_orderdate as created_at,
  cast(o_orderdate as date) as date
from {_ORDERS}""",
    "platform_health": """
select concat('health_', event_id) as metric_event_id,
  case event_type when 'click' then 'kafka' when 'error' then 'flink' when 'purchase' then 'paimon'
    when 'signup' then 'doris' else 'other' end as component,
  concat('metric_', user_id % 5) as metric_name,
  value as metric_value,
  cast(200 as double) as threshold,
  ts as created_at,
  cast(ts as date) as date
from events""",
    "access_audit": """
select concat('audit_', event_id) as audit_event_id,
  concat('user_', user_id) as user_id,
  case event_type when 'click' then 'query' when 'error' then 'export' when 'purchase' then 'view_prompt'
    when 'signup' then 'delete' else 'admin_override' end as action_type,
  'dashboard' as resource_type,
  concat('res_', event_id % 9) as resource_id,
  concat(repeat('a', case when event_id % 101 = 0 then 59 else 60 end),
    lpad(cast(event_id % 10000 as varchar(10)), 4, '0')) as ip_address,
  event_id % 8 <> 0 as access_granted,
  case when event_id % 8 = 0 and event_id % 16 <> 0 then 'restricted_data' else null end as denial_reason,
  case cast(event_id % 4 as int) when 0 then 'public' when 1 then 'internal' when 2 then 'confidential'
    else 'restricted' end as data_classification,
  ts as created_at,
  cast(ts as date) as date
from events""",
    "data_retention": """
select concat('retention_', event_id) as retention_event_id,
  concat('table_', user_id % 4) as table_name,
  cast(ts as date) as partition_date,
  case cast(event_id % 4 as int) when 0 then 'archive' when 1 then 'anonymize' when 2 then 'delete' else 'keep' end as action_type,
  event_id % 1000 - 5 as rows_affected,
  concat('policy_', user_id % 3) as policy_name,
  ts as created_at,
  cast(ts as date) as date
from events""",
    "model_deployment": """
select concat('deploy_', p_partkey) as deployment_id,
  concat('model_', p_partkey % 4) as model_name,
  p_brand as model_version,
  'vendor' as provider,
  case cast(p_partkey % 7 as int) when 0 then 'deploy' when 1 then 'rollback' when 2 then 'scale'
    when 3 then 'canary_start' when 4 then 'canary_promote' when 5 then 'canary_abort' else 'pause' end as deployment_action,
  cast(p_size * 2 as double) as traffic_percentage,
  case cast(p_partkey % 3 as int) when 0 then 'dev' when 1 then 'staging' else 'prod' end as target_environment,
  case cast(p_partkey % 3 as int) when 0 then 'success' when 1 then 'failed' else 'in_progress' end as status,
  cast('2024-01-01' as timestamp) as created_at,
  cast('2024-01-01' as date) as date
from part""",
    "user_dim": """
select concat('user_', c_custkey) as user_id, concat('team_', c_nationkey) as team_id
from customer where c_custkey % 10 <> 0""",
    "team_dim": """
select concat('team_', n) as team_id, concat('Team ', n) as team_name, 'Dept' as department,
  concat('CC-', n) as cost_center, cast(n * 10 + 5 as double) as budget_monthly_usd
from (select distinct c_nationkey as n from customer) t where n <> 7""",
    "model_dim": """
select concat('model_', m) as model_name, concat('vendor_', m) as provider,
  cast(m + 1 as double) / 4 as input_price_per_1m_tokens, cast(m + 1 as double) / 2 as output_price_per_1m_tokens
from (select distinct s_suppkey % 4 as m from supplier) t where m <> 3""",
    "sla_rule": """
select 'feature' as scope, f as feature_name, cast(3000 as double) as p95_latency_ms_max,
  cast(0.05 as double) as error_rate_max
from (select distinct o_orderpriority as f from orders) t where f <> '5-LOW'""",
    "experiment_assignment": f"""
select distinct concat('req_', l_orderkey, '_', l_linenumber) as request_id, c_mktsegment as dataset_name,
  'exp_1' as experiment_name,
  case when l_suppkey % 3 = 0 then 'baseline' else 'candidate' end as variant_name
from {_LINES}""",
    "experiment_comparison": """
select distinct c_mktsegment as dataset_name, 'exp_1' as experiment_name, 'baseline' as baseline_variant,
  'candidate' as candidate_variant
from customer""",
}
# External documents as JSON text, one per event; Spark only, the oracles read
# the columns the text is made of.
_AT = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS\")"
_UNTIL = "date_format(ts + event_id % 5000 * INTERVAL '0.001' SECOND, \"yyyy-MM-dd'T'HH:mm:ss.SSS\")"
DOCUMENTS: dict[str, str] = {
    "generation": f"""
select concat('{{"id":"gen_', event_id, '","traceId":"trace_', user_id, '","type":"', if(event_id % 53 = 0, 'SPAN', 'GENERATION'),
  '","startTime":"', {_AT}, 'Z","endTime":"', {_UNTIL}, 'Z","model":"model_', event_id % 4, '","level":"',
  if(event_type = 'error', 'ERROR', 'DEFAULT'), '","input":"question ', event_id % 100, '","output":{{"b":', event_id % 3, ',"a":"x"}},',
  if(event_id % 2 = 0, concat('"usageDetails":{{"input":', event_id % 90, ',"output":', event_id % 40, ',"total":',
    event_id % 90 + event_id % 40 + if(event_id % 37 = 0, 1, 0), '}}'),
    concat('"usage":{{"promptTokens":', event_id % 90, ',"completionTokens":', event_id % 40, '}}')),
  case event_id % 3 when 0 then concat(',"costDetails":{{"total":0.', lpad(cast(event_id % 1000 as string), 4, '0'), '}}') else '' end,
  ',"trace":{{"name":"flow_', event_id % 5, '","userId":"user_', user_id, '","sessionId":"session_', user_id % 7,
  '","metadata":{{"app_name":"app_', event_id % 3, '","environment":"dev","provider":"low"}}}},"metadata":{{"provider":"p', user_id % 3,
  '","prompt_category":"c","prompt_id":"prompt_', event_id % 9, '","prompt_version":"v', event_id % 2, '"',
  if(event_id % 11 = 0, '', ',"region":"us"'), if(event_id % 3 = 1, concat(',"estimated_cost_usd":0.', lpad(cast(event_id % 1000 as string), 4, '0')), ''),
  '}}}}') as value, event_id from (select /*+ repartition(event_id) */ * from events) e""",
    "score": f"""
select concat('{{"id":"score_', event_id, '","observationId":"req_', event_id % 500, '","timestamp":"', {_AT}, 'Z",',
  case event_id % 6 when 0 then '"source":"USER","name":"thumbs-up","value":1'
    when 1 then concat('"source":"MANUAL","name":"rating","value":', event_id % 8)
    when 2 then concat('"source":"EVALUATOR","name":"answer faithfulness","value":', cast(event_id % 120 as double) / 100,
      ',"config":{{"passThreshold":0.7}}')
    when 3 then '"source":"API","name":"quality","value":0.5'
    when 4 then '"source":"USER","name":"relevance","value":0.5'
    else concat('"source":"AUTOMATED","name":"toxicity","value":', cast(event_id % 100 as double) / 100) end,
  ',"metadata":{{"app_name":"app_', user_id % 3, '","feature_name":"f"}}}}') as value from (select /*+ repartition(event_id) */ * from events) e""",
    "trace": f"""
select concat('{{"id":"trace_', event_id, '","name":"flow","userId":"user_', user_id, '","sessionId":"s_', user_id % 7,
  '","metadata":{{"agent_id":"agent_', user_id % 5, '","agent_name":"a","app_name":"app","environment":"dev"',
  if(event_id % 4 = 0, '', concat(',"run_id":"run_', event_id, '","task_type":"t"')), '}},"observations":[',
  '{{"id":"span_', event_id, '","type":"SPAN","name":"root","startTime":"', {_AT}, 'Z","endTime":"', {_UNTIL}, 'Z"}},',
  '{{"id":"tool_', event_id, '","type":"TOOL","name":"tool_', event_id % 6, '","parentObservationId":"span_', event_id,
  '","startTime":"', {_AT}, 'Z","input":{{"q":', event_id % 10, '}},"output":"done","level":"', if(event_type = 'error', 'ERROR', 'DEFAULT'),
  '","metadata":{{"duration_ms":', event_id % 700, '}}}},',
  '{{"id":"ret_', event_id, '","type":"RETRIEVER","startTime":"', {_AT}, 'Z","input":"q","output":[{{"score":0.5}},{{"score":0.25}}],',
  '"metadata":{{"knowledge_base_id":"kb","embedding_model":"e","retrieval_strategy":"h","top_k":', event_id % 4,
  ',"latency_ms":', event_id % 900 + 1, '}}}},',
  '{{"id":"gen_', event_id, '","type":"GENERATION","startTime":"', {_AT}, 'Z","usageDetails":{{"total":', event_id % 50, '}}}}',
  if(event_id % 13 = 0, concat(',{{"id":"odd_', event_id, '","type":"EVENT"}}'), ''),
  '],"scores":[{{"id":"sc_', event_id, '","source":"USER","name":"like","value":1,"timestamp":"', {_AT}, 'Z"}}]}}') as value
from (select /*+ repartition(event_id) */ * from events) e""",
    # Eight turns of a conversation make one trajectory, so a document is
    # bounded however long a conversation gets.
    "trajectory": """
select concat('{"prompt_index":', conv_id, ',"conversations":[',
  array_join(transform(array_sort(collect_list(struct(turn, role, text))), x -> concat('{"from":"',
    case x.role when 'user' then 'human' when 'assistant' then 'gpt' else x.role end, '","value":',
    substring(to_json(array(x.text)), 2, length(to_json(array(x.text))) - 2), '}')), ','),
  '],"metadata":{"timestamp":"2026-01-15T10:30:00Z","session_id":"conv_', conv_id, '_', block, '"},"completed":',
  if(block % 2 = 0, 'true', 'false'), '}') as value
from (select conv_id, turn, turn div 8 as block, min(role) as role, min(text) as text from conversations
  group by conv_id, turn) t
group by conv_id, block""",
    # One visit with two tool calls, made of an event.
    "tool_trajectory": """
select concat('{"prompt_index":', event_id, ',"conversations":[{"from":"human","value":"q', event_id % 9, '"},',
  '{"from":"gpt","value":"on it","tool_calls":[{"id":"call_', event_id, '","function":{"name":"tool_', event_id % 6, '","arguments":{"n":', event_id % 10, '}}},',
  '{"name":"tool_', event_id % 4, '","arguments":"raw"}]},{"from":"tool","value":"', if(event_id % 7 = 0, 'Error: late', 'fine'), '"}],',
  '"metadata":{"timestamp":"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), 'Z","session_id":"visit_', event_id, '"},"completed":true}') as value
from (select /*+ repartition(event_id) */ * from events) e""",
}
FACTS = (
    "llm_request agent_run agent_span tool_call model_deployment retrieval feedback guardrail evaluation access_audit "
    "data_retention handoff platform_health"
).split()


_READ: dict[tuple[str, int, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its file listing and schema are read once per session."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir, name)
    if key not in _READ:
        _READ[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _READ[key]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived raw fact or dimension."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return _resolved(spark, sf_dir, VIEWS[name].replace(_LINES, _LINES_LAST))


def shared(spark: SparkSession, sf_dir: str, name: str, by_trace: bool = False) -> DataFrame:
    """`view`, for a fact that is read together with others; `by_trace`, if they are grouped by trace id (empty, not null, for an order without a key)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    sql, (lines, orders) = VIEWS[name], _shared("{}", "0")
    if by_trace:
        tasks = table(spark, sf_dir, "lineitem").count() // TASK_LINES
        lines, orders = _shared(_TRACE, "''", f"{tasks}, " if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else "")
        sql = sql.replace(_TRACE.format("l_orderkey"), "l_key").replace(_TRACE.format("o_orderkey"), "o_key")
    given, dealt = (_LINES, lines) if _LINES in sql else (_ORDERS, orders)
    return _resolved(spark, sf_dir, sql.replace(f"from {given}", f"from {dealt}"))


def documents(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """External documents of one kind, one JSON text per row.

    Building the text makes the rows many times larger than the columns they
    come from, so events are spread by their id before it.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return _resolved(spark, sf_dir, DOCUMENTS[name])


def _resolved(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    for given in TABLES:
        if re.search(rf"\b(from|join) \(?{given}\b", sql):
            table(spark, sf_dir, given).createOrReplaceTempView(given)
    return spark.sql(sql)
