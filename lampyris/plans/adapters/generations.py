"""Generation records (one JSON object per row) to request facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lampyris.contracts import LLM_REQUEST
from lampyris.functions.documents import (
    UNPARSABLE, columns, elapsed_ms, first_taken, integer, integer_in, json_taken, layered_taken, one_of, real, settled, sha, structure, taken,
    text, truth,
)
from lampyris.operators.quality import ERRORS, REJECTED, STATUS, VALID, with_source_evidence
from lampyris.plans.adapters import observation as obs

# --- Fixed values -----------------------------------------------------------
_REQUIRED = (
    "request_id", "trace_id", "user_id", "session_id", "app_name", "feature_name", "prompt_category", "prompt_id",
    "prompt_version", "model_name", "provider", "region", "environment", "created_at", "date",
)
_COLUMNS = (
    "request_id", "trace_id", "run_id", "span_id", "agent_id", "agent_name", "channel", "user_id", "session_id", "conversation_id",
    "app_name", "feature_name", "prompt_category", "prompt_id", "prompt_version", "model_name", "provider", "prompt_hash", "response_hash",
    "input_chars", "output_chars", "prompt_tokens", "completion_tokens", "total_tokens", "request_type", "is_streaming", "temperature",
    "max_tokens", "finish_reason", "retry_count", "latency_ms", "status", "error_type", "http_status", "estimated_cost_usd",
    "estimated_cost_source", "mode", "region", "environment", "created_at", "date",
)
_ID = ("id", "generationId", "observationId")
_INPUT = ("input", "prompt", "messages")
_OUTPUT = ("output", "completion", "response")
_TRACE_ID = ("traceId", "trace_id", "trace.id")
_PARENT = ("parentObservationId", "parent_observation_id")
_USER = ("userId", "user_id", "trace.userId")
_SESSION = ("sessionId", "session_id", "trace.sessionId")
_PROJECT = ("projectName",)
_TRACE_NAME = ("trace.name",)
_MODEL = ("model", "modelName")
_TEMPERATURE = ("modelParameters.temperature", "model_parameters.temperature")
_COUNTS = {kind: obs.token_paths(kind) for kind in obs.TOKEN_NAMES} | {"max_tokens": ["modelParameters.max_tokens", "modelParameters.maxTokens"]}
#: Names in the metadata. The record's own lie above those of the trace it embeds.
_LAYERS = ("metadata", "trace.metadata")
_NAMED = (
    "run_id", "agent_id", "agent_name", "channel", "user_id", "session_id", "conversation_id", "app_name", "feature_name",
    "prompt_category", "prompt_id", "prompt_name", "prompt_version", "model_name", "provider", "model_provider", "request_type",
    "is_streaming", "streaming", "finish_reason", "retry_count", "latency_ms", "duration_ms", "http_status", "status_code", "mode",
    "region", "environment", "env", *obs.STATUS, *obs.ERROR, *obs.METADATA_COST,
    *(name for names in obs.TOKEN_NAMES.values() for name in names),
)
_TEXTS = (
    _ID, _INPUT, _OUTPUT, _TRACE_ID, _PARENT, _USER, _SESSION, _PROJECT, _TRACE_NAME, _MODEL, _TEMPERATURE,
    obs.START, obs.END, obs.TYPE, obs.COST, obs.LEVEL, obs.MESSAGE,
)
#: Every value of a record that the rules below read.
_TAKEN = structure(
    string=[path for paths in _TEXTS for path in paths],
    variant=[path for paths in _COUNTS.values() for path in paths] + [f"{layer}.{name}" for layer in _LAYERS for name in _NAMED],
)


def _layered(record: str, *keys: str) -> str:
    return layered_taken([f"{record}.{layer}" for layer in _LAYERS], *keys)


_READ = obs.Reading(first_taken, _layered)


def _hashed(lines: DataFrame, column: str) -> DataFrame:
    """The parsed text with the hash of its canonical JSON, or of itself if it cannot be parsed."""
    canonical = F.coalesce(F.expr("cast(_record as string)"), F.col(column), F.lit(""))
    return lines.selectExpr(column, f"try_parse_json({column}) as _record").select(F.sha2(canonical, 256).alias("_payload_hash"), "_record")


def distinct_payloads(lines: DataFrame, column: str = "value") -> DataFrame:
    """Each distinct payload once, parsed; NULL if it cannot be.

    Payloads are equal when their canonical JSON is; repeats collapse on the
    map side, so a record replayed very often costs one row.
    """
    return _hashed(lines, column).groupBy("_payload_hash").agg(F.first("_record").alias("_record"))


def normalize(lines: DataFrame, column: str = "value", deduplicate: bool = True, only_labels: bool = False) -> DataFrame:
    """Normalised requests with error labels, status and source evidence.

    Text that cannot be parsed becomes a reject of its own. With `only_labels` the request's id is the only one of its columns.
    """
    source = distinct_payloads(lines, column) if deduplicate else _hashed(lines, column)
    records = (
        source.selectExpr("_payload_hash", "_record is null as _broken", f"{taken('_record', _TAKEN)} as r")
        .selectExpr(
            "*",
            *columns(
                started=obs.start_time("r", _READ),
                ended=obs.end_time("r", _READ),
                stated_status=obs.stated_status("r", _READ),
                prompt_held=json_taken("r", *_COUNTS["prompt"]),
                completion_held=json_taken("r", *_COUNTS["completion"]),
                total_held=json_taken("r", *_COUNTS["total"]),
            ),
        )
    )
    basics = records.selectExpr(
        "*",
        *columns(
            status=obs.status_in("stated_status", "r", _READ),
            prompt_tokens=obs.tokens_in("prompt_held", "r", "prompt", _READ),
            completion_tokens=obs.tokens_in("completion_held", "r", "completion", _READ),
            given_total=obs.tokens_in("total_held", "r", "total", _READ),
        ),
    )

    def m(*keys: str) -> str:
        return _layered("r", *keys)

    # What a rule reads; all else is computed above the labels, so only where it is asked for.
    judged = basics.selectExpr(
        "_payload_hash", "_broken", "r",
        *columns(
            request_id=text(first_taken("r", *_ID)),
            trace_id=text(first_taken("r", *_TRACE_ID)),
            user_id=text(one_of(first_taken("r", *_USER), m("user_id"))),
            session_id=text(one_of(first_taken("r", *_SESSION), m("session_id"))),
            app_name=text(one_of(m("app_name"), first_taken("r", *_PROJECT))),
            feature_name=text(one_of(m("feature_name"), first_taken("r", *_TRACE_NAME))),
            prompt_category=text(m("prompt_category")),
            prompt_id=text(m("prompt_id", "prompt_name")),
            prompt_version=text(m("prompt_version")),
            model_name=text(one_of(first_taken("r", *_MODEL), m("model_name"))),
            provider=text(m("provider", "model_provider")),
            prompt_tokens="prompt_tokens",
            completion_tokens="completion_tokens",
            total_tokens="coalesce(given_total, prompt_tokens + completion_tokens)",
            latency_ms=f"coalesce({elapsed_ms('started', 'ended')}, {integer(m('latency_ms', 'duration_ms'), 0)})",
            status="status",
            http_status=integer(m("http_status", "status_code"), "if(status = 'error', 500, 200)"),
            estimated_cost_usd=obs.cost("r", "r", _READ),
            mode=text(m("mode"), "replay"),
            region=text(m("region")),
            environment=text(m("environment", "env")),
            created_at="started",
            date="cast(started as date)",
            _type=f"lower({text(first_taken('r', *obs.TYPE), 'generation')})",
        ),
    )
    checks = obs.missing("", _REQUIRED) + [
        ("prompt_tokens is null", "completeness:missing_prompt_tokens"),
        ("prompt_tokens < 0", "validity:negative_prompt_tokens"),
        ("completion_tokens is null", "completeness:missing_completion_tokens"),
        ("completion_tokens < 0", "validity:negative_completion_tokens"),
        ("total_tokens is null", "completeness:missing_total_tokens"),
        ("total_tokens <> prompt_tokens + completion_tokens", "consistency:token_total_mismatch"),
        ("latency_ms <= 0", "validity:non_positive_latency"),
        ("status not in ('success', 'error')", "validity:invalid_status"),
        ("estimated_cost_usd < 0", "validity:negative_cost"),
        ("mode not in ('mock', 'live', 'replay', 'hermes')", "validity:invalid_mode"),
        ("http_status not between 100 and 599", "validity:invalid_http_status"),
        ("_type <> 'generation'", "validity:unsupported_observation_type"),
    ]
    labels = F.when(F.col("_broken"), F.array(F.lit(UNPARSABLE))).otherwise(F.expr(obs.labels_if_any(checks)))
    checked = judged.withColumn(ERRORS, labels)
    checked = settled(checked.withColumn(STATUS, F.expr(f"if(size({ERRORS}) = 0, '{VALID}', '{REJECTED}')")))
    if only_labels:
        normalized = checked.selectExpr("request_id", "request_id as _source_id", ERRORS, STATUS, "_payload_hash")
    else:
        texts = checked.selectExpr("*", *columns(input_text=text(first_taken("r", *_INPUT)), output_text=text(first_taken("r", *_OUTPUT))))
        rest = {
            "run_id": text(m("run_id")),
            "span_id": f"coalesce({text(first_taken('r', *_PARENT), None)}, request_id)",
            "agent_id": text(m("agent_id")),
            "agent_name": text(m("agent_name")),
            "channel": text(m("channel")),
            "conversation_id": text(m("conversation_id")),
            "prompt_hash": sha("input_text"),
            "response_hash": sha("output_text"),
            "input_chars": "length(input_text)",
            "output_chars": "length(output_text)",
            "request_type": text(m("request_type"), "chat"),
            "is_streaming": truth(m("is_streaming", "streaming")),
            "temperature": real(first_taken("r", *_TEMPERATURE), 0.0),
            "max_tokens": f"coalesce({integer_in(json_taken('r', *_COUNTS['max_tokens']))}, 0)",
            "finish_reason": f"coalesce({text(m('finish_reason'), None)}, if(status = 'error', 'error', 'stop'))",
            "retry_count": integer(m("retry_count"), 0),
            "error_type": obs.error_type("r", "r", "status", read=_READ),
            "estimated_cost_source": obs.cost_source("r", "r", _READ),
        }
        normalized = texts.selectExpr(*columns(**{name: rest.get(name, name) for name in _COLUMNS}), "request_id as _source_id", ERRORS, STATUS, "_payload_hash")
    evidence = with_source_evidence(normalized, "langfuse", "generation", F.col("_source_id"), None, F.col("_payload_hash"))
    return evidence.drop("_payload_hash")


def requests(normalized: DataFrame) -> DataFrame:
    """Accepted records as the request fact plus the cost source."""
    accepted = normalized.where(F.col(STATUS) == VALID)
    typed = [f"cast({f.name} as {f.type_name}) as {f.name}" for f in LLM_REQUEST.fields]
    return accepted.selectExpr(*typed, "estimated_cost_source")


def rejects(normalized: DataFrame) -> DataFrame:
    return normalized.where(F.col(STATUS) == REJECTED)
