"""Fact contracts: declared columns, defaults, keys and quality rules.

A contract is the single description of one fact table.  It yields the Spark
schema for scans, the typed projection used by batch and stream, and the
rules the quality operator evaluates.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}
_NO_DEFAULT = object()


@dataclass(frozen=True)
class Field:
    name: str
    type_name: str
    default: object = _NO_DEFAULT
    nullable: bool = False

    @property
    def has_default(self) -> bool:
        return self.default is not _NO_DEFAULT

    @property
    def data_type(self) -> T.DataType:
        return _SPARK_TYPES[self.type_name]

    @property
    def default_sql(self) -> str:
        value = self.default if self.has_default else None
        return f"cast({sql_literal(value)} as {self.type_name})"


@dataclass(frozen=True)
class Rule:
    """One row rule: rows for which ``predicate`` is false carry ``label``."""

    predicate: str
    category: str
    code: str

    @property
    def label(self) -> str:
        return f"{self.category}:{self.code}"


@dataclass(frozen=True)
class FactContract:
    name: str
    key: str
    grain: str
    fields: tuple[Field, ...]
    rules: tuple[Rule, ...] = ()
    null_fill: tuple[tuple[str, str], ...] = ()

    @cached_property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.data_type, True) for f in self.fields])

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def project(self, raw: DataFrame, fill_nulls: bool = False) -> DataFrame:
        """Cast ``raw`` to the contract; undeclared columns are dropped.

        An absent column takes the field default.  A NULL in a present column
        stays NULL unless ``fill_nulls`` is set (the streaming convention).
        Values that cannot be cast become NULL so the rules can reject them.
        """
        present = {column.name: column.dataType for column in raw.schema.fields}
        always_filled = dict(self.null_fill)
        out = []
        for field in self.fields:
            if field.name not in present:
                column = field.default_sql
            else:
                column = _tolerant_cast(field, present[field.name])
                if fill_nulls and field.has_default:
                    column = f"coalesce({column}, {field.default_sql})"
            if field.name in always_filled:
                column = f"coalesce({column}, {sql_literal(always_filled[field.name])})"
            out.append(f"{column} as `{field.name}`")
        return raw.selectExpr(*out)


def sql_literal(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def _tolerant_cast(field: Field, source: T.DataType) -> str:
    column = f"`{field.name}`"
    if source == field.data_type:
        return column
    if isinstance(source, T.NullType):
        return f"cast(null as {field.type_name})"
    if isinstance(source, T.StringType) and field.type_name == "date":
        # Date text may carry a time part; the day is what counts.
        return f"cast(try_cast({column} as timestamp) as date)"
    return f"try_cast({column} as {field.type_name})"


def _field(text: str) -> Field:
    name, _, spec = text.strip().partition(":")
    spec, has_default, literal = spec.partition("=")
    nullable = spec.endswith("?")
    type_name = spec.rstrip("?")
    if not has_default:
        return Field(name, type_name, nullable=nullable)
    if type_name == "string":
        value: object = literal
    elif type_name == "boolean":
        value = literal == "true"
    elif type_name == "double":
        value = float(literal)
    else:
        value = int(literal)
    return Field(name, type_name, value, nullable)


def _fields(text: str) -> tuple[Field, ...]:
    return tuple(_field(part) for part in text.replace("\n", " ").split(",") if part.strip())


def _rules(text: str) -> tuple[Rule, ...]:
    rules = []
    for line in text.strip().splitlines():
        label, _, predicate = line.strip().partition(" <- ")
        category, _, code = label.partition(":")
        rules.append(Rule(predicate.strip(), category.strip(), code.strip()))
    return tuple(rules)


# --- Fixed values ---------------------------------------------------------
# Column names, order, types, defaults, rule predicates and rule codes are the
# published data model; results depend on them being exactly these.
# Notation: name:type, "?" nullable, "=x" default for an absent column.

LLM_REQUEST = FactContract(
    name="llm_request",
    key="request_id",
    grain="one provider request attempt",
    fields=_fields(
        """
        request_id:string, trace_id:string=, run_id:string=, span_id:string=, agent_id:string=,
        agent_name:string=, channel:string=, user_id:string, session_id:string, conversation_id:string=,
        app_name:string, feature_name:string, prompt_category:string, prompt_id:string,
        prompt_version:string, model_name:string, provider:string, prompt_hash:string=,
        response_hash:string=, input_chars:int=0, output_chars:int=0, prompt_tokens:int,
        completion_tokens:int, total_tokens:int, request_type:string=chat, is_streaming:boolean=false,
        temperature:double=0, max_tokens:int=0, finish_reason:string=, retry_count:int=0,
        latency_ms:int, status:string, error_type:string?, http_status:int, estimated_cost_usd:double,
        mode:string, region:string, environment:string, created_at:timestamp, date:date
        """
    ),
    rules=_rules(
        """
        completeness:missing_request_id <- request_id IS NOT NULL
        completeness:missing_created_at <- created_at IS NOT NULL
        validity:negative_prompt_tokens <- prompt_tokens >= 0
        validity:negative_completion_tokens <- completion_tokens >= 0
        consistency:token_total_mismatch <- total_tokens = prompt_tokens + completion_tokens
        validity:non_positive_latency <- latency_ms > 0
        validity:invalid_status <- status IN ('success', 'error')
        validity:negative_cost <- estimated_cost_usd >= 0
        validity:invalid_mode <- mode IN ('mock', 'live', 'replay', 'hermes')
        """
    ),
)

AGENT_RUN = FactContract(
    name="agent_run",
    key="run_id",
    grain="one agent task",
    fields=_fields(
        """
        run_id:string, trace_id:string=, agent_id:string, agent_name:string, agent_version:string=,
        app_name:string, user_id:string, session_id:string, conversation_id:string=, task_type:string,
        channel:string=, toolsets_used:string?, input_text_hash:string=, output_text_hash:string=,
        start_time:timestamp, end_time:timestamp, duration_ms:int, status:string, error_type:string?,
        turn_count:int=0, llm_call_count:int=0, tool_call_count:int=0, retrieval_count:int=0,
        total_tokens:int=0, estimated_cost_usd:double=0, mode:string, region:string,
        environment:string, created_at:timestamp, date:date
        """
    ),
    null_fill=(("toolsets_used", "[]"),),
)

AGENT_SPAN = FactContract(
    name="agent_span",
    key="span_id",
    grain="one agent runtime span",
    fields=_fields(
        """
        span_id:string, parent_span_id:string?, run_id:string, trace_id:string=, agent_id:string,
        span_name:string, span_type:string, span_order:int=0, start_time:timestamp,
        end_time:timestamp, duration_ms:int, status:string, error_type:string?, retry_count:int=0,
        input_size:int=0, output_size:int=0, model_name:string?, tool_name:string?, mode:string,
        region:string, environment:string, created_at:timestamp, date:date
        """
    ),
)

TOOL_CALL = FactContract(
    name="tool_call",
    key="tool_call_id",
    grain="one agent tool invocation",
    fields=_fields(
        """
        tool_call_id:string, span_id:string, run_id:string, trace_id:string=, agent_id:string,
        tool_name:string, tool_type:string, arguments_json:string, result_text:string,
        result_size:int=0, duration_ms:int, status:string, error_type:string?, retry_count:int=0,
        mode:string, region:string, environment:string, created_at:timestamp, date:date
        """
    ),
)

MODEL_DEPLOYMENT = FactContract(
    name="model_deployment",
    key="deployment_id",
    grain="one model deployment action",
    fields=_fields(
        """
        deployment_id:string, model_name:string, model_version:string, provider:string,
        deployment_action:string, traffic_percentage:double, target_environment:string,
        deployer_user_id:string, deploy_reason:string=, status:string, created_at:timestamp, date:date
        """
    ),
    # The last four rules have no published codes; the names here follow the pattern.
    rules=_rules(
        """
        completeness:missing_deployment_id <- deployment_id IS NOT NULL
        completeness:missing_created_at <- created_at IS NOT NULL
        validity:invalid_deployment_action <- deployment_action IN ('deploy', 'rollback', 'scale', 'canary_start', 'canary_promote', 'canary_abort')
        validity:invalid_traffic_percentage <- traffic_percentage BETWEEN 0.0 AND 100.0
        validity:invalid_target_environment <- target_environment IN ('dev', 'staging', 'prod')
        validity:invalid_status <- status IN ('success', 'failed', 'in_progress')
        """
    ),
)

RETRIEVAL = FactContract(
    name="retrieval",
    key="retrieval_id",
    grain="one retrieval request",
    fields=_fields(
        """
        retrieval_id:string, trace_id:string=, run_id:string=, span_id:string=, request_id:string=,
        agent_id:string=, app_name:string, feature_name:string, user_id:string,
        knowledge_base_id:string, knowledge_base_name:string=, embedding_model:string,
        retrieval_strategy:string, query_text_hash:string=, query_length:int=0, top_k:int,
        returned_count:int, hit_count:int, max_similarity_score:double, min_similarity_score:double,
        avg_similarity_score:double, embedding_latency_ms:int, search_latency_ms:int,
        total_latency_ms:int, status:string, error_type:string?, mode:string, environment:string,
        created_at:timestamp, date:date
        """
    ),
    rules=_rules(
        """
        completeness:missing_retrieval_id <- retrieval_id IS NOT NULL
        completeness:missing_created_at <- created_at IS NOT NULL
        validity:non_positive_top_k <- top_k > 0
        validity:negative_returned_count <- returned_count >= 0
        validity:negative_hit_count <- hit_count >= 0
        consistency:hit_count_exceeds_returned_count <- hit_count <= returned_count
        validity:non_positive_total_latency <- total_latency_ms > 0
        validity:invalid_status <- status IN ('success', 'error')
        validity:invalid_mode <- mode IN ('mock', 'live', 'replay')
        """
    ),
)

FEEDBACK = FactContract(
    name="feedback",
    key="feedback_id",
    grain="one feedback action",
    fields=_fields(
        """
        feedback_id:string, trace_id:string=, request_id:string=, run_id:string=, session_id:string,
        conversation_id:string=, user_id:string, app_name:string, feature_name:string,
        agent_id:string=, feedback_type:string, rating_value:int?, feedback_text_hash:string=,
        feedback_text_length:int=0, response_latency_ms:int, model_name:string, prompt_version:string,
        mode:string, environment:string, created_at:timestamp, date:date
        """
    ),
    rules=_rules(
        """
        completeness:missing_feedback_id <- feedback_id IS NOT NULL
        completeness:missing_created_at <- created_at IS NOT NULL
        validity:invalid_feedback_type <- feedback_type IN ('thumbs_up', 'thumbs_down', 'rating', 'regenerate', 'edit', 'report')
        validity:invalid_rating_value <- (rating_value IS NULL OR rating_value BETWEEN 1 AND 5)
        validity:non_positive_response_latency <- response_latency_ms > 0
        validity:invalid_mode <- mode IN ('mock', 'live')
        """
    ),
)

GUARDRAIL = FactContract(
    name="guardrail",
    key="guardrail_event_id",
    grain="one guardrail rule evaluation",
    fields=_fields(
        """
        guardrail_event_id:string, trace_id:string=, request_id:string=, run_id:string=,
        user_id:string, app_name:string, feature_name:string, guardrail_stage:string,
        rule_name:string, rule_category:string, triggered:boolean, action_taken:string,
        severity:string, matched_pattern_hash:string=, input_text_length:int=0,
        guardrail_latency_ms:int, model_name:string, prompt_version:string, mode:string,
        environment:string, created_at:timestamp, date:date
        """
    ),
    rules=_rules(
        """
        completeness:missing_guardrail_event_id <- guardrail_event_id IS NOT NULL
        completeness:missing_created_at <- created_at IS NOT NULL
        validity:invalid_guardrail_stage <- guardrail_stage IN ('pre_request', 'post_response')
        validity:invalid_rule_category <- rule_category IN ('content_filter', 'pii_detection', 'toxicity', 'topic_block', 'length_limit')
        validity:invalid_action_taken <- action_taken IN ('pass', 'warn', 'block', 'redact', 'override')
        validity:invalid_severity <- severity IN ('low', 'medium', 'high', 'critical')
        validity:non_positive_guardrail_latency <- guardrail_latency_ms > 0
        validity:invalid_mode <- mode IN ('mock', 'live')
        """
    ),
)

EVALUATION = FactContract(
    name="evaluation",
    key="evaluation_id",
    grain="one evaluation judgment",
    fields=_fields(
        """
        evaluation_id:string, trace_id:string=, request_id:string=, run_id:string=, app_name:string,
        feature_name:string, evaluator_type:string, evaluator_model:string=,
        evaluation_dimension:string, score:double, raw_score:string=, pass_threshold:double,
        passed:boolean, evaluated_model_name:string, evaluated_prompt_version:string,
        evaluation_latency_ms:int, mode:string, environment:string, created_at:timestamp, date:date
        """
    ),
    rules=_rules(
        """
        completeness:missing_evaluation_id <- evaluation_id IS NOT NULL
        completeness:missing_created_at <- created_at IS NOT NULL
        validity:invalid_evaluator_type <- evaluator_type IN ('llm_judge', 'human', 'ground_truth', 'regex', 'classifier')
        validity:invalid_evaluation_dimension <- evaluation_dimension IN ('relevance', 'faithfulness', 'coherence', 'toxicity', 'hallucination')
        validity:invalid_score <- score BETWEEN 0.0 AND 1.0
        validity:invalid_pass_threshold <- pass_threshold BETWEEN 0.0 AND 1.0
        validity:non_positive_evaluation_latency <- evaluation_latency_ms > 0
        validity:invalid_mode <- mode IN ('mock', 'live', 'offline')
        """
    ),
)

ACCESS_AUDIT = FactContract(
    name="access_audit",
    key="audit_event_id",
    grain="one access attempt",
    fields=_fields(
        """
        audit_event_id:string, user_id:string, action_type:string, resource_type:string,
        resource_id:string, ip_address:string, access_granted:boolean, denial_reason:string?,
        data_classification:string, created_at:timestamp, date:date
        """
    ),
    rules=_rules(
        """
        completeness:missing_audit_event_id <- audit_event_id IS NOT NULL
        completeness:missing_created_at <- created_at IS NOT NULL
        validity:invalid_ip_hash <- CHAR_LENGTH(ip_address) = 64
        validity:invalid_action_type <- action_type IN ('query', 'export', 'view_prompt', 'view_response', 'delete', 'admin_override')
        validity:invalid_resource_type <- resource_type IN ('dashboard', 'dwd_table', 'raw_log', 'prompt_text', 'response_text')
        validity:invalid_data_classification <- data_classification IN ('public', 'internal', 'confidential', 'restricted')
        consistency:missing_denial_reason <- (access_granted OR denial_reason IS NOT NULL)
        """
    ),
)

DATA_RETENTION = FactContract(
    name="data_retention",
    key="retention_event_id",
    grain="one retention action on a table partition",
    fields=_fields(
        """
        retention_event_id:string, table_name:string, partition_date:date, action_type:string,
        rows_affected:bigint, policy_name:string, created_at:timestamp, date:date
        """
    ),
    rules=_rules(
        """
        completeness:missing_retention_event_id <- retention_event_id IS NOT NULL
        completeness:missing_created_at <- created_at IS NOT NULL
        completeness:missing_partition_date <- partition_date IS NOT NULL
        validity:invalid_action_type <- action_type IN ('archive', 'anonymize', 'delete')
        validity:negative_rows_affected <- rows_affected >= 0
        completeness:missing_policy_name <- policy_name IS NOT NULL
        """
    ),
)

HANDOFF = FactContract(
    name="handoff",
    key="orchestration_id",
    grain="one inter-agent handoff",
    fields=_fields(
        """
        orchestration_id:string, trace_id:string, parent_run_id:string, child_run_id:string,
        parent_agent_id:string, child_agent_id:string, handoff_type:string, payload_size:int,
        handoff_latency_ms:int, status:string, created_at:timestamp, date:date
        """
    ),
    rules=_rules(
        """
        completeness:missing_orchestration_id <- orchestration_id IS NOT NULL
        completeness:missing_created_at <- created_at IS NOT NULL
        consistency:identical_run_ids <- parent_run_id <> child_run_id
        consistency:identical_agent_ids <- parent_agent_id <> child_agent_id
        validity:invalid_handoff_type <- handoff_type IN ('delegate', 'callback', 'broadcast', 'sequential')
        validity:negative_payload_size <- payload_size >= 0
        validity:negative_handoff_latency <- handoff_latency_ms >= 0
        validity:invalid_status <- status IN ('success', 'error', 'timeout')
        """
    ),
)

PLATFORM_HEALTH = FactContract(
    name="platform_health",
    key="metric_event_id",
    grain="one platform metric observation",
    fields=_fields(
        """
        metric_event_id:string, component:string, metric_name:string, metric_value:double,
        threshold:double, created_at:timestamp, date:date
        """
    ),
    # No published codes; the names here follow the pattern.
    rules=_rules(
        """
        validity:invalid_component <- component IN ('kafka', 'flink', 'paimon', 'doris')
        validity:negative_metric_value <- metric_value >= 0
        validity:negative_threshold <- threshold >= 0
        """
    ),
)

CONTRACTS: dict[str, FactContract] = {
    contract.name: contract
    for contract in (
        LLM_REQUEST,
        AGENT_RUN,
        AGENT_SPAN,
        TOOL_CALL,
        MODEL_DEPLOYMENT,
        RETRIEVAL,
        FEEDBACK,
        GUARDRAIL,
        EVALUATION,
        ACCESS_AUDIT,
        DATA_RETENTION,
        HANDOFF,
        PLATFORM_HEALTH,
    )
}
