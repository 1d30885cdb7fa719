"""Score records to feedback actions and evaluation judgments.

A score may stand alone or be embedded in a trace; ``t`` is the trace context
(VARIANT with id, name, user, session and metadata) and may be NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lampyris.contracts import EVALUATION, FEEDBACK
from lampyris.functions.documents import (
    at, columns, first_of, instant, integer, is_set, layered, one_of, overlay, parsed, real, settled, sha, signal, text,
    text_map, truth, unparsable,
)
from lampyris.operators.quality import ERRORS, REJECTED, STATUS, VALID, with_source_evidence
from lampyris.plans.adapters.observation import labels, missing

# --- Fixed values: accepted tags and spellings -------------------------------
FEEDBACK_TYPES = ("thumbs_up", "thumbs_down", "rating", "regenerate", "edit", "report")
EVALUATOR_TYPES = ("llm_judge", "human", "ground_truth", "regex", "classifier")
DIMENSIONS = ("relevance", "faithfulness", "coherence", "toxicity", "hallucination")
FEEDBACK_SOURCES = ("user", "manual", "feedback", "user_feedback", "manual_feedback")
EVALUATION_SOURCES = (
    "automated", "auto", "dataset-run", "dataset_run", "eval", "evaluation", "evaluator", "judge", "test",
)
FEEDBACK_TAGS = FEEDBACK_SOURCES + FEEDBACK_TYPES + ("thumbs", "thumbs-up", "thumbs-down")
EVALUATION_TAGS = (
    EVALUATION_SOURCES + EVALUATOR_TYPES + DIMENSIONS + ("dataset", "groundtruth", "ground-truth", "pass_threshold")
)
FEEDBACK_SYNONYMS = {
    "thumbs_up": ("thumbs-up", "thumbsup", "like"),
    "thumbs_down": ("thumbs-down", "thumbsdown", "dislike"),
    "regenerate": ("regeneration", "retry"),
    "report": ("flag", "flagged"),
}
EVALUATOR_SYNONYMS = {
    "llm_judge": ("judge", "evaluator", "llm", "llm-judge", "llmjudge"),
    "ground_truth": ("dataset-run", "dataset_run", "test", "ground-truth", "groundtruth"),
    "classifier": ("automated", "auto", "classifier"),
    "regex": ("rule", "rules"),
}
_NAME = ("name", "scoreName", "score_name")
_VALUE = ("value", "score", "numericValue", "numeric_value")
_TIME = ("timestamp", "createdAt", "created_at", "eventTime", "event_time")
_ID = ("id", "scoreId", "score_id")
# Metadata objects, topmost first.
_LAYERS = ("metadata", "score_config", "scoreConfig", "config")

NO_CONTEXT = "cast(null as variant)"


def _in(value: str, options: tuple[str, ...]) -> str:
    return f"{value} in ({', '.join(repr(o) for o in options)})"


def _array(options: tuple[str, ...]) -> str:
    return f"array({', '.join(repr(o) for o in options)})"


def _synonyms(value: str, own: tuple[str, ...], others: dict[str, tuple[str, ...]], otherwise: str) -> str:
    cases = " ".join(f"when {_in(value, words)} then '{name}'" for name, words in others.items())
    return f"case when {_in(value, own)} then {value} {cases} else {otherwise} end"


def normalize(scores: DataFrame, only_labels: bool = False) -> DataFrame:
    """One row per score with class, all event columns, labels and evidence.

    ``scores`` has VARIANT columns ``s`` (the score) and ``t`` (trace context).
    With ``only_labels`` the ids are the only event columns.
    """
    payload = "sha2(cast(s as string), 256)"
    layers = [f"m{i}" for i in range(len(_LAYERS))]
    merged = scores.selectExpr(
        "s", "t", f"{text_map('t', 'metadata')} as tm", *[f"{text_map('s', p)} as {n}" for n, p in zip(layers, _LAYERS)]
    ).withColumn("tags", F.col(layers[0]))
    for layer in (*layers[1:], "tm"):
        # Settled step by step: every merge mentions the one before it.
        merged = settled(merged.withColumn("tags", F.expr(overlay("tags", layer))))
    merged = merged.select("s", "t", "tm", "tags")

    def m(*keys: str) -> str:
        return layered("tags", *keys)

    def context(*paths: str, default: str = "''") -> str:
        """Record, merged metadata, trace metadata, trace; the first that has it."""
        trace_id = [first_of("t", "id", "traceId", "trace_id")] if {"traceId", "trace_id"} & set(paths) else []
        chain = one_of(first_of("s", *paths), m(*paths), layered("tm", *paths), *trace_id, first_of("t", *paths))
        return f"coalesce({text(chain, None)}, {default})"

    name = signal(text(first_of("s", *_NAME)))
    value = first_of("s", *_VALUE)
    basics = merged.selectExpr(
        "*",
        *columns(
            source=signal(text(one_of(first_of("s", "source"), m("source")))),
            name=name,
            created_at=instant(first_of("s", *_TIME)),
            score=f"case when coalesce({text(value, None)}, '') <> '' then coalesce({real(value)}, double('NaN')) end",
            signals=(
                f"filter(concat(array({signal(text(first_of('s', 'source')))}, {name}, "
                f"{signal(text(first_of('s', 'dataType', 'data_type')))}), "
                f"transform(map_values(tags), x -> {signal('x')})), x -> x <> '')"
            ),
            feedback_text=text(one_of(first_of("s", "comment", "reason", "text"), m("comment", "reason"))),
            pass_threshold=real(m("pass_threshold", "passThreshold"), 0.5),
            explicit_feedback=signal(text(m("feedback_type", "feedbackType"))),
            explicit_rating=integer(m("rating_value", "ratingValue")),
            evaluator=signal(text(one_of(m("evaluator_type", "evaluatorType"), first_of("s", "source")))),
            explicit_dimension=signal(text(m("evaluation_dimension", "dimension"))),
            stated_pass=f"{text(one_of(first_of('s', 'passed'), m('passed')), None)}",
            pass_flag=truth(one_of(first_of("s", "passed"), m("passed"))),
        ),
    )
    named_evaluation = one_of(
        m(
            "evaluator_type", "evaluatorType", "evaluation_dimension", "dimension", "pass_threshold", "passThreshold"
        )
    )
    run_or_item = m("dataset_run_id", "datasetRunId", "dataset_item_id", "datasetItemId")
    classed = basics.selectExpr(
        "*",
        *columns(
            is_feedback=(
                f"{_in('source', FEEDBACK_SOURCES)} or arrays_overlap(signals, {_array(FEEDBACK_TAGS)}) or "
                f"{is_set(m('feedback_type', 'feedbackType'))}"
            ),
            is_evaluation=(
                f"{_in('source', EVALUATION_SOURCES)} or arrays_overlap(signals, {_array(EVALUATION_TAGS)}) or "
                f"{is_set(named_evaluation)} or {is_set(run_or_item)}"
            ),
            thumbs="if(score is not null, if(score >= 0.5 and not isnan(score), 'thumbs_up', 'thumbs_down'), '')",
        ),
    )
    by_name = _synonyms("name", FEEDBACK_TYPES, FEEDBACK_SYNONYMS, "thumbs")
    found_dimension = " ".join(f"when contains(name, '{d}') then '{d}'" for d in DIMENSIONS)
    typed = classed.selectExpr(
        "*",
        *columns(
            score_class="case when is_feedback and is_evaluation then 'conflict' when is_feedback then 'feedback' "
            "when is_evaluation then 'evaluation' when source <> '' or name <> '' then 'unknown' else 'missing' end",
            feedback_type=f"if({_in('explicit_feedback', FEEDBACK_TYPES)}, explicit_feedback, {by_name})",
            evaluator_type=_synonyms("evaluator", EVALUATOR_TYPES, EVALUATOR_SYNONYMS, "evaluator"),
            evaluation_dimension=(
                f"case when {_in('explicit_dimension', DIMENSIONS)} then explicit_dimension {found_dimension} "
                "else coalesce(nullif(explicit_dimension, ''), name) end"
            ),
        ),
    )
    unit_rating = "cast(least(5, greatest(1, bround(score * 4, 0) + 1)) as bigint)"
    observed = text(first_of("s", "observationId", "observation_id"))
    mode = f"lower({text(m('mode'))})"
    events = typed.selectExpr(
        "s", "score_class",
        *columns(
            score_id=f"coalesce(nullif({text(first_of('s', *_ID))}, ''), concat('score_', substring({payload}, 1, 16)))",
            trace_id=context("traceId", "trace_id"),
            request_id=context("requestId", "request_id", default=observed),
            run_id=context("runId", "run_id"),
            session_id=context("sessionId", "session_id"),
            conversation_id=text(m("conversation_id")),
            user_id=context("userId", "user_id"),
            app_name=context("projectName", "app_name"),
            feature_name=context("feature_name", default=text(first_of("t", "name"))),
            environment=context("environment", "env"),
            agent_id=text(m("agent_id")),
            feedback_type="feedback_type",
            rating_value=(
                "case when explicit_rating is not null then explicit_rating when feedback_type <> 'rating' then null "
                "when score between 1 and 5 and score = floor(score) then cast(score as bigint) "
                f"when score between 0 and 1 then {unit_rating} else try_cast(score as bigint) end"
            ),
            feedback_text_hash=sha("feedback_text"),
            feedback_text_length="length(feedback_text)",
            response_latency_ms=integer(m("response_latency_ms", "latency_ms"), 1),
            model_name=text(m("model_name", "evaluated_model_name")),
            prompt_version=text(m("prompt_version", "evaluated_prompt_version")),
            evaluator_type="evaluator_type",
            evaluator_model=text(m("evaluator_model", "evaluatorModel", "judge_model")),
            evaluation_dimension="evaluation_dimension",
            score="score",
            raw_score=text(value),
            pass_threshold="pass_threshold",
            passed="if(stated_pass is not null, pass_flag, coalesce(score >= pass_threshold and not isnan(score), false))",
            evaluated_model_name=text(m("evaluated_model_name", "model_name")),
            evaluated_prompt_version=text(m("evaluated_prompt_version", "prompt_version")),
            evaluation_latency_ms=integer(m("evaluation_latency_ms", "latency_ms"), 1),
            mode=(
                f"if(score_class = 'feedback', if({mode} in ('mock', 'live'), {mode}, 'live'), "
                f"if({mode} in ('mock', 'live', 'offline'), {mode}, 'offline'))"
            ),
            created_at="created_at",
            date="cast(created_at as date)",
            _source_id=text(first_of("s", *_ID)),
            # The evidence looks only at the record and the trace itself.
            _evidence_trace=(
                "coalesce("
                + text(
                    one_of(
                        first_of("s", "traceId", "trace_id"), layered("tm", "traceId", "trace_id"),
                        first_of("t", "id", "traceId", "trace_id"),
                    ),
                    None,
                )
                + ", '')"
            ),
        ),
    )
    fb, ev = "score_class = 'feedback'", "score_class = 'evaluation'"
    either = f"({fb} or {ev})"

    def dated(kind: str, prefix: str) -> list[tuple[str, str]]:
        return [(f"{kind} and {cond}", label) for cond, label in missing(prefix, ("created_at", "date"))]

    checks = [
        ("score_class = 'conflict'", "consistency:conflicting_score_classification"),
        ("score_class = 'unknown'", "validity:unknown_score_classification"),
        ("score_class = 'missing'", "completeness:missing_score_classification"),
        (f"{either} and trace_id = '' and request_id = '' and run_id = ''", "completeness:missing_score_target"),
        *dated(fb, "feedback_action"),
        (f"{fb} and not {_in('feedback_type', FEEDBACK_TYPES)}", "validity:invalid_feedback_type"),
        (f"{fb} and rating_value not between 1 and 5", "validity:invalid_rating_value"),
        (f"{fb} and response_latency_ms <= 0", "validity:non_positive_response_latency"),
        *dated(ev, "evaluation_judgment"),
        (f"{ev} and score is null", "completeness:missing_score"),
        (f"{ev} and not (score between 0 and 1)", "validity:invalid_score_range"),
        (f"{ev} and pass_threshold not between 0 and 1", "validity:invalid_pass_threshold"),
        (f"{ev} and not {_in('evaluator_type', EVALUATOR_TYPES)}", "validity:invalid_evaluator_type"),
        (f"{ev} and not {_in('evaluation_dimension', DIMENSIONS)}", "validity:invalid_evaluation_dimension"),
        (f"{ev} and evaluation_latency_ms <= 0", "validity:non_positive_evaluation_latency"),
    ]
    checked = events.withColumn(ERRORS, F.expr(labels(checks)))
    checked = checked.withColumn(STATUS, F.expr(f"if(size({ERRORS}) = 0, '{VALID}', '{REJECTED}')"))
    if only_labels:
        checked = checked.select("s", "score_id", "trace_id", "_source_id", "_evidence_trace", ERRORS, STATUS)
    # The payload's hash stands above the barrier, so only rows and queries that show it pay for it.
    evidence = with_source_evidence(
        settled(checked), "langfuse", "score_event", F.col("_source_id"), F.col("_evidence_trace"), F.expr(payload)
    )
    return evidence.drop("s", "_evidence_trace")


def standalone(lines: DataFrame, column: str = "value") -> DataFrame:
    """Score documents without trace context, ready for ``normalize``."""
    return parsed(lines, column, "s").selectExpr("s", f"{NO_CONTEXT} as t")


def unparsable_documents(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines that hold no document."""
    return unparsable(lines, column, "langfuse", "score_event")


def _facts(normalized: DataFrame, score_class: str, contract, key: str) -> DataFrame:
    rows = normalized.where((F.col(STATUS) == VALID) & (F.col("score_class") == score_class))
    rows = rows.withColumnRenamed("score_id", key)
    return rows.selectExpr(*[f"cast({f.name} as {f.type_name}) as {f.name}" for f in contract.fields])


def feedback_actions(normalized: DataFrame) -> DataFrame:
    return _facts(normalized, "feedback", FEEDBACK, "feedback_id")


def evaluation_judgments(normalized: DataFrame) -> DataFrame:
    return _facts(normalized, "evaluation", EVALUATION, "evaluation_id")


def rejects(normalized: DataFrame) -> DataFrame:
    return normalized.where(F.col(STATUS) == REJECTED)
