"""Expected facts and rules as literal SQL, written out so that no oracle depends on the engine's contracts.

Columns, defaults and rules are fixed values of the data model.
"""

from __future__ import annotations

# Select list of each fact: columns of its view, else the default of an absent column.
COLUMNS: dict[str, str] = {
    "llm_request": """
        cast(request_id as varchar) as request_id, cast(trace_id as varchar) as trace_id, cast(run_id as varchar) as run_id,
        cast('' as varchar) as span_id, cast('' as varchar) as agent_id, cast('' as varchar) as agent_name, cast('' as
        varchar) as channel, cast(user_id as varchar) as user_id, cast(session_id as varchar) as session_id, cast('' as
        varchar) as conversation_id, cast(app_name as varchar) as app_name, cast(feature_name as varchar) as feature_name,
        cast(null as varchar) as prompt_category, cast(prompt_id as varchar) as prompt_id, cast(prompt_version as varchar) as
        prompt_version, cast(model_name as varchar) as model_name, cast(null as varchar) as provider, cast('' as varchar) as
        prompt_hash, cast('' as varchar) as response_hash, cast(0 as integer) as input_chars, cast(0 as integer) as
        output_chars, cast(prompt_tokens as integer) as prompt_tokens, cast(completion_tokens as integer) as
        completion_tokens, cast(total_tokens as integer) as total_tokens, cast('chat' as varchar) as request_type, cast(false
        as boolean) as is_streaming, cast(0.0 as double) as temperature, cast(0 as integer) as max_tokens, cast('' as varchar)
        as finish_reason, cast(0 as integer) as retry_count, cast(latency_ms as integer) as latency_ms, cast(status as
        varchar) as status, cast(null as varchar) as error_type, cast(null as integer) as http_status, cast(estimated_cost_usd
        as double) as estimated_cost_usd, cast(mode as varchar) as mode, cast(region as varchar) as region, cast(environment
        as varchar) as environment, cast(created_at as timestamp) as created_at, cast(date as date) as date""",
    "agent_run": """
        cast(run_id as varchar) as run_id, cast(trace_id as varchar) as trace_id, cast(agent_id as varchar) as agent_id,
        cast(agent_name as varchar) as agent_name, cast('' as varchar) as agent_version, cast(app_name as varchar) as
        app_name, cast(user_id as varchar) as user_id, cast(session_id as varchar) as session_id, cast('' as varchar) as
        conversation_id, cast(task_type as varchar) as task_type, cast('' as varchar) as channel, cast('[]' as varchar) as
        toolsets_used, cast('' as varchar) as input_text_hash, cast('' as varchar) as output_text_hash, cast(start_time as
        timestamp) as start_time, cast(null as timestamp) as end_time, cast(duration_ms as integer) as duration_ms,
        cast(status as varchar) as status, cast(null as varchar) as error_type, cast(turn_count as integer) as turn_count,
        cast(llm_call_count as integer) as llm_call_count, cast(tool_call_count as integer) as tool_call_count,
        cast(retrieval_count as integer) as retrieval_count, cast(total_tokens as integer) as total_tokens,
        cast(estimated_cost_usd as double) as estimated_cost_usd, cast(mode as varchar) as mode, cast(null as varchar) as
        region, cast(environment as varchar) as environment, cast(created_at as timestamp) as created_at, cast(date as date)
        as date""",
    "agent_span": """
        cast(span_id as varchar) as span_id, cast(null as varchar) as parent_span_id, cast(run_id as varchar) as run_id,
        cast(trace_id as varchar) as trace_id, cast(agent_id as varchar) as agent_id, cast(span_name as varchar) as span_name,
        cast(span_type as varchar) as span_type, cast(span_order as integer) as span_order, cast(start_time as timestamp) as
        start_time, cast(null as timestamp) as end_time, cast(duration_ms as integer) as duration_ms, cast(status as varchar)
        as status, cast(null as varchar) as error_type, cast(0 as integer) as retry_count, cast(0 as integer) as input_size,
        cast(0 as integer) as output_size, cast(null as varchar) as model_name, cast(null as varchar) as tool_name, cast(mode
        as varchar) as mode, cast(null as varchar) as region, cast(environment as varchar) as environment, cast(created_at as
        timestamp) as created_at, cast(date as date) as date""",
    "tool_call": """
        cast(tool_call_id as varchar) as tool_call_id, cast(span_id as varchar) as span_id, cast(run_id as varchar) as run_id,
        cast(trace_id as varchar) as trace_id, cast(agent_id as varchar) as agent_id, cast(tool_name as varchar) as tool_name,
        cast(tool_type as varchar) as tool_type, cast(null as varchar) as arguments_json, cast(null as varchar) as
        result_text, cast(result_size as integer) as result_size, cast(duration_ms as integer) as duration_ms, cast(status as
        varchar) as status, cast(null as varchar) as error_type, cast(retry_count as integer) as retry_count, cast(mode as
        varchar) as mode, cast(null as varchar) as region, cast(environment as varchar) as environment, cast(created_at as
        timestamp) as created_at, cast(date as date) as date""",
    "model_deployment": """
        cast(deployment_id as varchar) as deployment_id, cast(model_name as varchar) as model_name, cast(model_version as
        varchar) as model_version, cast(provider as varchar) as provider, cast(deployment_action as varchar) as
        deployment_action, cast(traffic_percentage as double) as traffic_percentage, cast(target_environment as varchar) as
        target_environment, cast(null as varchar) as deployer_user_id, cast('' as varchar) as deploy_reason, cast(status as
        varchar) as status, cast(created_at as timestamp) as created_at, cast(date as date) as date""",
    "retrieval": """
        cast(retrieval_id as varchar) as retrieval_id, cast(trace_id as varchar) as trace_id, cast(run_id as varchar) as
        run_id, cast('' as varchar) as span_id, cast(request_id as varchar) as request_id, cast('' as varchar) as agent_id,
        cast(app_name as varchar) as app_name, cast(feature_name as varchar) as feature_name, cast(user_id as varchar) as
        user_id, cast(knowledge_base_id as varchar) as knowledge_base_id, cast(knowledge_base_name as varchar) as
        knowledge_base_name, cast(embedding_model as varchar) as embedding_model, cast(retrieval_strategy as varchar) as
        retrieval_strategy, cast('' as varchar) as query_text_hash, cast(0 as integer) as query_length, cast(top_k as integer)
        as top_k, cast(returned_count as integer) as returned_count, cast(hit_count as integer) as hit_count, cast(null as
        double) as max_similarity_score, cast(null as double) as min_similarity_score, cast(avg_similarity_score as double) as
        avg_similarity_score, cast(embedding_latency_ms as integer) as embedding_latency_ms, cast(search_latency_ms as
        integer) as search_latency_ms, cast(total_latency_ms as integer) as total_latency_ms, cast(status as varchar) as
        status, cast(null as varchar) as error_type, cast(mode as varchar) as mode, cast(environment as varchar) as
        environment, cast(created_at as timestamp) as created_at, cast(date as date) as date""",
    "feedback": """
        cast(feedback_id as varchar) as feedback_id, cast('' as varchar) as trace_id, cast(request_id as varchar) as
        request_id, cast('' as varchar) as run_id, cast(session_id as varchar) as session_id, cast('' as varchar) as
        conversation_id, cast(user_id as varchar) as user_id, cast(app_name as varchar) as app_name, cast(feature_name as
        varchar) as feature_name, cast(agent_id as varchar) as agent_id, cast(feedback_type as varchar) as feedback_type,
        cast(rating_value as integer) as rating_value, cast('' as varchar) as feedback_text_hash, cast(0 as integer) as
        feedback_text_length, cast(response_latency_ms as integer) as response_latency_ms, cast(null as varchar) as
        model_name, cast(null as varchar) as prompt_version, cast(mode as varchar) as mode, cast(environment as varchar) as
        environment, cast(created_at as timestamp) as created_at, cast(date as date) as date""",
    "guardrail": """
        cast(guardrail_event_id as varchar) as guardrail_event_id, cast('' as varchar) as trace_id, cast('' as varchar) as
        request_id, cast('' as varchar) as run_id, cast(user_id as varchar) as user_id, cast(app_name as varchar) as app_name,
        cast(null as varchar) as feature_name, cast(guardrail_stage as varchar) as guardrail_stage, cast(rule_name as varchar)
        as rule_name, cast(rule_category as varchar) as rule_category, cast(triggered as boolean) as triggered,
        cast(action_taken as varchar) as action_taken, cast(severity as varchar) as severity, cast('' as varchar) as
        matched_pattern_hash, cast(0 as integer) as input_text_length, cast(guardrail_latency_ms as integer) as
        guardrail_latency_ms, cast(null as varchar) as model_name, cast(null as varchar) as prompt_version, cast(mode as
        varchar) as mode, cast(environment as varchar) as environment, cast(created_at as timestamp) as created_at, cast(date
        as date) as date""",
    "evaluation": """
        cast(evaluation_id as varchar) as evaluation_id, cast('' as varchar) as trace_id, cast(request_id as varchar) as
        request_id, cast('' as varchar) as run_id, cast(app_name as varchar) as app_name, cast(feature_name as varchar) as
        feature_name, cast(evaluator_type as varchar) as evaluator_type, cast('' as varchar) as evaluator_model,
        cast(evaluation_dimension as varchar) as evaluation_dimension, cast(score as double) as score, cast('' as varchar) as
        raw_score, cast(pass_threshold as double) as pass_threshold, cast(passed as boolean) as passed,
        cast(evaluated_model_name as varchar) as evaluated_model_name, cast(evaluated_prompt_version as varchar) as
        evaluated_prompt_version, cast(evaluation_latency_ms as integer) as evaluation_latency_ms, cast(mode as varchar) as
        mode, cast(environment as varchar) as environment, cast(created_at as timestamp) as created_at, cast(date as date) as
        date""",
    "access_audit": """
        cast(audit_event_id as varchar) as audit_event_id, cast(user_id as varchar) as user_id, cast(action_type as varchar)
        as action_type, cast(resource_type as varchar) as resource_type, cast(resource_id as varchar) as resource_id,
        cast(ip_address as varchar) as ip_address, cast(access_granted as boolean) as access_granted, cast(denial_reason as
        varchar) as denial_reason, cast(data_classification as varchar) as data_classification, cast(created_at as timestamp)
        as created_at, cast(date as date) as date""",
    "data_retention": """
        cast(retention_event_id as varchar) as retention_event_id, cast(table_name as varchar) as table_name,
        cast(partition_date as date) as partition_date, cast(action_type as varchar) as action_type, cast(rows_affected as
        bigint) as rows_affected, cast(policy_name as varchar) as policy_name, cast(created_at as timestamp) as created_at,
        cast(date as date) as date""",
    "handoff": """
        cast(orchestration_id as varchar) as orchestration_id, cast(trace_id as varchar) as trace_id, cast(parent_run_id as
        varchar) as parent_run_id, cast(child_run_id as varchar) as child_run_id, cast(parent_agent_id as varchar) as
        parent_agent_id, cast(child_agent_id as varchar) as child_agent_id, cast(handoff_type as varchar) as handoff_type,
        cast(payload_size as integer) as payload_size, cast(handoff_latency_ms as integer) as handoff_latency_ms, cast(status
        as varchar) as status, cast(created_at as timestamp) as created_at, cast(date as date) as date""",
    "platform_health": """
        cast(metric_event_id as varchar) as metric_event_id, cast(component as varchar) as component, cast(metric_name as
        varchar) as metric_name, cast(metric_value as double) as metric_value, cast(threshold as double) as threshold,
        cast(created_at as timestamp) as created_at, cast(date as date) as date""",
}

# Rules of each fact in order: label and what has to hold. NULL holds in batch and fails in streams.
RULES: dict[str, tuple[tuple[str, str], ...]] = {
    "llm_request": (
        ("completeness:missing_request_id", "request_id IS NOT NULL"),
        ("completeness:missing_created_at", "created_at IS NOT NULL"),
        ("validity:negative_prompt_tokens", "prompt_tokens >= 0"),
        ("validity:negative_completion_tokens", "completion_tokens >= 0"),
        ("consistency:token_total_mismatch", "total_tokens = prompt_tokens + completion_tokens"),
        ("validity:non_positive_latency", "latency_ms > 0"),
        ("validity:invalid_status", "status IN ('success', 'error')"),
        ("validity:negative_cost", "estimated_cost_usd >= 0"),
        ("validity:invalid_mode", "mode IN ('mock', 'live', 'replay', 'hermes')"),
    ),
    "model_deployment": (
        ("completeness:missing_deployment_id", "deployment_id IS NOT NULL"),
        ("completeness:missing_created_at", "created_at IS NOT NULL"),
        ("validity:invalid_deployment_action", "deployment_action IN ('deploy', 'rollback', 'scale', 'canary_start', 'canary_promote', 'canary_abort')"),
        ("validity:invalid_traffic_percentage", "traffic_percentage BETWEEN 0.0 AND 100.0"),
        ("validity:invalid_target_environment", "target_environment IN ('dev', 'staging', 'prod')"),
        ("validity:invalid_status", "status IN ('success', 'failed', 'in_progress')"),
    ),
    "retrieval": (
        ("completeness:missing_retrieval_id", "retrieval_id IS NOT NULL"),
        ("completeness:missing_created_at", "created_at IS NOT NULL"),
        ("validity:non_positive_top_k", "top_k > 0"),
        ("validity:negative_returned_count", "returned_count >= 0"),
        ("validity:negative_hit_count", "hit_count >= 0"),
        ("consistency:hit_count_exceeds_returned_count", "hit_count <= returned_count"),
        ("validity:non_positive_total_latency", "total_latency_ms > 0"),
        ("validity:invalid_status", "status IN ('success', 'error')"),
        ("validity:invalid_mode", "mode IN ('mock', 'live', 'replay')"),
    ),
    "feedback": (
        ("completeness:missing_feedback_id", "feedback_id IS NOT NULL"),
        ("completeness:missing_created_at", "created_at IS NOT NULL"),
        ("validity:invalid_feedback_type", "feedback_type IN ('thumbs_up', 'thumbs_down', 'rating', 'regenerate', 'edit', 'report')"),
        ("validity:invalid_rating_value", "(rating_value IS NULL OR rating_value BETWEEN 1 AND 5)"),
        ("validity:non_positive_response_latency", "response_latency_ms > 0"),
        ("validity:invalid_mode", "mode IN ('mock', 'live')"),
    ),
    "guardrail": (
        ("completeness:missing_guardrail_event_id", "guardrail_event_id IS NOT NULL"),
        ("completeness:missing_created_at", "created_at IS NOT NULL"),
        ("validity:invalid_guardrail_stage", "guardrail_stage IN ('pre_request', 'post_response')"),
        ("validity:invalid_rule_category", "rule_category IN ('content_filter', 'pii_detection', 'toxicity', 'topic_block', 'length_limit')"),
        ("validity:invalid_action_taken", "action_taken IN ('pass', 'warn', 'block', 'redact', 'override')"),
        ("validity:invalid_severity", "severity IN ('low', 'medium', 'high', 'critical')"),
        ("validity:non_positive_guardrail_latency", "guardrail_latency_ms > 0"),
        ("validity:invalid_mode", "mode IN ('mock', 'live')"),
    ),
    "evaluation": (
        ("completeness:missing_evaluation_id", "evaluation_id IS NOT NULL"),
        ("completeness:missing_created_at", "created_at IS NOT NULL"),
        ("validity:invalid_evaluator_type", "evaluator_type IN ('llm_judge', 'human', 'ground_truth', 'regex', 'classifier')"),
        ("validity:invalid_evaluation_dimension", "evaluation_dimension IN ('relevance', 'faithfulness', 'coherence', 'toxicity', 'hallucination')"),
        ("validity:invalid_score", "score BETWEEN 0.0 AND 1.0"),
        ("validity:invalid_pass_threshold", "pass_threshold BETWEEN 0.0 AND 1.0"),
        ("validity:non_positive_evaluation_latency", "evaluation_latency_ms > 0"),
        ("validity:invalid_mode", "mode IN ('mock', 'live', 'offline')"),
    ),
    "access_audit": (
        ("completeness:missing_audit_event_id", "audit_event_id IS NOT NULL"),
        ("completeness:missing_created_at", "created_at IS NOT NULL"),
        ("validity:invalid_ip_hash", "CHAR_LENGTH(ip_address) = 64"),
        ("validity:invalid_action_type", "action_type IN ('query', 'export', 'view_prompt', 'view_response', 'delete', 'admin_override')"),
        ("validity:invalid_resource_type", "resource_type IN ('dashboard', 'dwd_table', 'raw_log', 'prompt_text', 'response_text')"),
        ("validity:invalid_data_classification", "data_classification IN ('public', 'internal', 'confidential', 'restricted')"),
        ("consistency:missing_denial_reason", "(access_granted OR denial_reason IS NOT NULL)"),
    ),
    "data_retention": (
        ("completeness:missing_retention_event_id", "retention_event_id IS NOT NULL"),
        ("completeness:missing_created_at", "created_at IS NOT NULL"),
        ("completeness:missing_partition_date", "partition_date IS NOT NULL"),
        ("validity:invalid_action_type", "action_type IN ('archive', 'anonymize', 'delete')"),
        ("validity:negative_rows_affected", "rows_affected >= 0"),
        ("completeness:missing_policy_name", "policy_name IS NOT NULL"),
    ),
    "handoff": (
        ("completeness:missing_orchestration_id", "orchestration_id IS NOT NULL"),
        ("completeness:missing_created_at", "created_at IS NOT NULL"),
        ("consistency:identical_run_ids", "parent_run_id <> child_run_id"),
        ("consistency:identical_agent_ids", "parent_agent_id <> child_agent_id"),
        ("validity:invalid_handoff_type", "handoff_type IN ('delegate', 'callback', 'broadcast', 'sequential')"),
        ("validity:negative_payload_size", "payload_size >= 0"),
        ("validity:negative_handoff_latency", "handoff_latency_ms >= 0"),
        ("validity:invalid_status", "status IN ('success', 'error', 'timeout')"),
    ),
    "platform_health": (
        ("validity:invalid_component", "component IN ('kafka', 'flink', 'paimon', 'doris')"),
        ("validity:negative_metric_value", "metric_value >= 0"),
        ("validity:negative_threshold", "threshold >= 0"),
    ),
}
