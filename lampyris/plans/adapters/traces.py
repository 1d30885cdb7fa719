"""Nested trace documents to envelopes, runs, spans, tool calls, retrievals and scores.

Everything about one trace is computed inside its row with higher-order
functions; observations are then exploded carrying only the trace's slim
context.  No shuffle is needed, and a trace's own document size is the only
bound on a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lampyris.contracts import AGENT_RUN, AGENT_SPAN, RETRIEVAL, TOOL_CALL, FactContract
from lampyris.functions.documents import (
    at, columns, elapsed_ms, first_list, first_of, integer, is_object, json_list, layered, layered_variant, objects, one_of, overlay, parsed, present,
    real, settled, sha, text, text_map, unparsable, variant_of, variants,
)
from lampyris.operators.quality import ERRORS, REJECTED, STATUS, VALID, with_source_evidence
from lampyris.plans.adapters import observation as obs
from lampyris.plans.adapters import scores as score_adapter

# --- Fixed values -------------------------------------------------------------
SPAN_TYPES = ("span", "chain")
TOOL_TYPES = ("tool",)
RETRIEVAL_TYPES = ("retriever", "retrieval")
KNOWN_TYPES = SPAN_TYPES + TOOL_TYPES + RETRIEVAL_TYPES + ("generation",)
_RUN_REQUIRED = (
    "run_id", "trace_id", "agent_id", "agent_name", "app_name", "user_id", "session_id", "task_type", "start_time",
    "end_time", "created_at", "date", "environment",
)
_SPAN_REQUIRED = ("span_id", "trace_id", "span_name", "span_type", "start_time", "end_time", "created_at", "date")
_TOOL_REQUIRED = (
    "tool_call_id", "span_id", "trace_id", "tool_name", "tool_type", "duration_ms", "status", "environment",
    "created_at", "date",
)
_RETRIEVAL_REQUIRED = (
    "retrieval_id", "trace_id", "app_name", "feature_name", "user_id", "knowledge_base_id", "embedding_model",
    "retrieval_strategy", "top_k", "returned_count", "hit_count", "total_latency_ms", "status", "environment",
    "created_at", "date",
)
# Where an observation's metadata objects are, topmost first (not merged).
_OBJECTS = ("try_variant_get(o, '$.metadata', 'variant')", "try_variant_get(o, '$.trace.metadata', 'variant')")
_SCORE_LISTS = ("scores", "scoreEvents", "score_events")


def _in(value: str, options: Sequence[str]) -> str:
    return f"{value} in ({', '.join(repr(o) for o in options)})"


def _type(record: str) -> str:
    return f"lower({text(first_of(record, *obs.TYPE))})"


def _duration(record: str, md: str) -> str:
    start, end = obs.start_time(record), obs.end_time(record)
    return f"coalesce({elapsed_ms(start, end)}, {integer(layered(md, 'duration_ms', 'latency_ms'))})"


def _end(record: str, md: str) -> str:
    start = obs.start_time(record)
    return f"coalesce({obs.end_time(record)}, timestampadd(MILLISECOND, {_duration(record, md)}, {start}))"


def documents(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per trace document with its context and its lists of observations and scores."""
    inner = present(at("r", "trace"))
    opened = parsed(lines, column, "r").selectExpr("r", f"if({is_object(inner)}, {inner}, r) as t").selectExpr(
        "r", "t", f"{text_map('t', 'metadata')} as tm",
        f"coalesce({objects(first_list(('r', 'observations'), ('r', 'trace.observations')))}, array()) as vs",
        f"coalesce({objects(first_list(*[(root, name) for root in 'rt' for name in _SCORE_LISTS]))}, array()) as ss",
    )

    def m(*keys: str) -> str:
        return layered("tm", *keys)

    named = opened.selectExpr(
        "*",
        *columns(
            trace_id=text(first_of("t", "id", "traceId", "trace_id")),
            trace_name=text(first_of("t", "name")),
            user_id=text(one_of(first_of("t", "userId", "user_id"), m("user_id"))),
            session_id=text(one_of(first_of("t", "sessionId", "session_id"), m("session_id"))),
            meta_run=text(m("run_id", "agent_run_id")),
            meta_task=text(m("task_type", "agent_task_type")),
            is_dated=f"{obs.start_time('t')} is not null or exists(vs, v -> {obs.start_time('v')} is not null)",
        ),
    )
    run = "(meta_run <> '' and meta_task <> '')"
    rolled = named.selectExpr("*", f"{run} as has_run", f"if({run}, meta_run, '') as run_id")
    checks = obs.missing("trace_envelope", ("trace_id",))
    checks += [("not is_dated", label) for _, label in obs.missing("trace_envelope", ("created_at", "date"))]
    return rolled.withColumn("envelope_errors", F.expr(obs.labels(checks))).drop("is_dated")


def _intact(traces: DataFrame, *needed: str, where: str = "true") -> DataFrame:
    """Columns of the usable traces that also meet the condition; what nobody asks for is not computed."""
    usable = settled(traces.select(*needed, F.expr(f"size(envelope_errors) = 0 and {where}").alias("usable")))
    return usable.where("usable").drop("usable")


def _started(traces: DataFrame) -> DataFrame:
    """With the start of the trace, else the first of its observations."""
    started = f"coalesce({obs.start_time('t')}, array_min(transform(vs, v -> {obs.start_time('v')})))"
    return traces.withColumn("started", F.expr(started)).selectExpr("*", "started as created_at", "cast(started as date) as date")


def envelopes(traces: DataFrame) -> DataFrame:
    """Correlation ids and bounds of every usable trace."""
    needed = ("t", "tm", "vs", "trace_id", "trace_name", "run_id", "has_run", "user_id", "session_id")
    return _started(_intact(traces, *needed)).selectExpr(
        "trace_id", "'langfuse' as source_system", "'trace' as source_entity", "trace_name", "run_id",
        "has_run as has_run_metadata", f"{text(layered('tm', 'app_name'))} as app_name",
        f"coalesce({text(layered('tm', 'feature_name'), None)}, trace_name) as feature_name", "user_id", "session_id",
        f"{text(layered('tm', 'environment', 'env'))} as environment", "created_at", "date",
        "size(vs) as observation_count",
    )


def _checked(
    frame: DataFrame, checks: list[tuple[str, str]], entity: str, source: str, source_trace: str, only_labels: bool = False
) -> DataFrame:
    """Rows with labels, status and evidence; with `only_labels` only the trace id of their other columns."""
    labelled = frame.withColumn(ERRORS, F.expr(obs.labels(checks)))
    labelled = labelled.withColumn(STATUS, F.expr(f"if(size({ERRORS}) = 0, '{VALID}', '{REJECTED}')"))
    if only_labels:
        labelled = labelled.select(source, F.col(source_trace).alias("_trace"), "trace_id", ERRORS, STATUS)
        source_trace = "_trace"
    # Evidence stands above the barrier, so only rows and queries that show it pay for it.
    source_id = F.expr(text(first_of(source, "id", "observationId", "traceId")))
    payload = F.expr(f"sha2(cast({source} as string), 256)")
    return with_source_evidence(settled(labelled), "langfuse", entity, source_id, F.expr(source_trace), payload).drop(source)


def _with_metadata(traces: DataFrame) -> DataFrame:
    """os: each observation (v) with its own metadata and the one merged over the trace's (md)."""
    own, embedded = obs.metadata_parts("v")
    parts = traces.withColumn("os", F.expr(f"transform(vs, v -> named_struct('v', v, 'a', {own}, 'b', {embedded}))"))
    parts = parts.withColumn("os", F.expr(f"transform(os, x -> named_struct('v', x.v, 'own', {overlay('x.a', 'x.b')}))"))
    return parts.withColumn("os", F.expr(f"transform(os, x -> named_struct('v', x.v, 'own', x.own, 'md', {overlay('x.own', 'tm')}))")).drop("vs")


def runs(traces: DataFrame, only_labels: bool = False) -> DataFrame:
    """Agent runs of traces that name both a run and a task."""

    def m(*keys: str) -> str:
        return layered("tm", *keys)

    def count(options: Sequence[str]) -> str:
        return f"size(filter(types, x -> {_in('x', options)}))"

    tool_name = text(one_of(layered("o.md", "tool_name"), first_of("o.v", "name")))
    tools = f"filter(os, o -> {_in(_type('o.v'), TOOL_TYPES)})"
    names = f"array_sort(array_distinct(filter(transform({tools}, o -> {tool_name}), x -> x <> '')))"
    error = obs.error_type("o.v", "o.md", obs.status("o.v", "o.md"))
    first_error = f"get(filter(transform(os, o -> {error}), x -> x is not null), 0)"
    stated_error = f"nullif({text(m('error_type', 'error'))}, '')"
    trace_message = text(first_of("t", "statusMessage", "status_message"), "trace_error")
    input_text = text(one_of(first_of("t", "input"), m("input")))
    output_text = text(one_of(first_of("t", "output"), m("output")))
    statuses = f"transform(os, o -> {obs.status('o.v', 'o.md')})"
    stated = f"lower({text(m('status'))})"
    needed = ("r", "t", "tm", "vs", "trace_id", "user_id", "session_id", "meta_run", "meta_task")
    rolled = _with_metadata(_started(_intact(traces, *needed, where="has_run"))).selectExpr(
        "*",
        f"coalesce({obs.end_time('t')}, array_max(transform(os, o -> {_end('o.v', 'o.md')}))) as ended",
        f"transform(os, o -> {_type('o.v')}) as types",
        f"case when {stated} in ('success', 'error') then {stated} "
        f"when lower({text(first_of('t', 'level'))}) in ('error', 'fatal') then 'error' "
        f"when array_contains({statuses}, 'error') then 'error' else 'success' end as status",
    )
    events = rolled.selectExpr(
        "r",
        *columns(
            run_id="meta_run",
            trace_id="trace_id",
            agent_id=text(m("agent_id")),
            agent_name=text(m("agent_name")),
            agent_version=text(m("agent_version")),
            app_name=text(m("app_name")),
            user_id="user_id",
            session_id="session_id",
            conversation_id=text(m("conversation_id")),
            task_type="meta_task",
            channel=text(m("channel")),
            toolsets_used=json_list(names),
            input_text_hash=sha(input_text),
            output_text_hash=sha(output_text),
            start_time="started",
            end_time="ended",
            duration_ms=f"coalesce({elapsed_ms('started', 'ended')}, 0)",
            status="status",
            error_type=f"if(status = 'error', coalesce({stated_error}, {first_error}, {trace_message}), '')",
            turn_count=integer(m("turn_count"), 0),
            llm_call_count=count(("generation",)),
            tool_call_count=count(TOOL_TYPES),
            retrieval_count=count(RETRIEVAL_TYPES),
            total_tokens=f"aggregate(transform(os, o -> coalesce({obs.tokens('o.v', 'o.own', 'total')}, 0L)), 0L, (a, x) -> a + x)",
            estimated_cost_usd=f"aggregate(transform(os, o -> {obs.cost('o.v', 'o.own')}), 0D, (a, x) -> a + x)",
            mode=text(m("mode"), "replay"),
            region=text(m("region")),
            environment=text(m("environment", "env")),
            created_at="created_at",
            date="date",
        ),
    )
    checks = obs.missing("agent_run", _RUN_REQUIRED) + [("duration_ms <= 0", "validity:non_positive_duration")]
    return _checked(events, checks, "trace", "r", "trace_id", only_labels)


def _exploded(traces: DataFrame, options: Sequence[str]) -> DataFrame:
    """Observations of the given types with their position among them."""
    picked = f"filter(vs, v -> {_in(_type('v'), options)})"
    needed = ("trace_id", "trace_name", "user_id", "has_run", "run_id", "tm", "vs")
    rows = _intact(traces, *needed).selectExpr(
        "trace_id as doc_trace_id", "trace_name", "user_id", "has_run", "run_id as doc_run_id", "tm", f"posexplode({picked}) as (position, o)",
    )
    own, embedded = obs.metadata_parts("o")
    return rows.selectExpr("*", f"{own} as own", f"{embedded} as embedded").selectExpr("*", f"{overlay('own', 'embedded')} as stated").selectExpr(
        "doc_trace_id", "trace_name", "user_id", "has_run", "doc_run_id", "position", "o", f"{overlay('stated', 'tm')} as md",
    ).selectExpr(
        "*",
        *columns(
            own_id=text(first_of("o", "id", "observationId", "observation_id")),
            parent_id=text(first_of("o", "parentObservationId", "parent_observation_id")),
            own_trace=f"coalesce({text(first_of('o', 'traceId', 'trace_id'), None)}, doc_trace_id)",
            own_run=f"if(has_run, doc_run_id, {text(layered('md', 'run_id'))})",
            started=obs.start_time("o"),
            end_given=obs.end_time("o"),
            stated_ms=integer(layered("md", "duration_ms", "latency_ms")),
            own_status=obs.status("o", "md"),
        ),
    ).selectExpr("*", f"coalesce({elapsed_ms('started', 'end_given')}, stated_ms) as took").selectExpr(
        "*", "coalesce(end_given, timestampadd(MILLISECOND, took, started)) as ended"
    )


def _common() -> dict[str, str]:
    return dict(
        run_id="own_run",
        trace_id="own_trace",
        agent_id=text(layered("md", "agent_id")),
        status="own_status",
        error_type=f"coalesce({obs.error_type('o', 'md', 'own_status')}, '')",
        mode=text(layered("md", "mode"), "replay"),
        environment=text(layered("md", "environment", "env")),
        created_at="started",
        date="cast(started as date)",
    )


def spans(traces: DataFrame, only_labels: bool = False) -> DataFrame:
    events = _exploded(traces, SPAN_TYPES).selectExpr(
        "o", "doc_trace_id",
        *columns(
            span_id="own_id",
            parent_span_id="nullif(parent_id, '')",
            span_name=text(first_of("o", "name")),
            span_type=_type("o"),
            span_order="position + 1",
            start_time="started",
            end_time="ended",
            duration_ms="coalesce(took, 0)",
            retry_count=integer(layered("md", "retry_count"), 0),
            input_size=f"length({text(first_of('o', 'input'))})",
            output_size=f"length({text(first_of('o', 'output'))})",
            model_name=text(one_of(first_of("o", "model"), layered("md", "model_name"))),
            tool_name=text(layered("md", "tool_name")),
            region=text(layered("md", "region")),
            **_common(),
        ),
    )
    checks = obs.missing("agent_span", _SPAN_REQUIRED) + [("duration_ms <= 0", "validity:non_positive_duration")]
    return _checked(events, checks, "observation", "o", "doc_trace_id", only_labels).drop("doc_trace_id")


def tool_calls(traces: DataFrame, only_labels: bool = False) -> DataFrame:
    arguments = one_of(variant_of("o", "input"), layered_variant(_OBJECTS, "arguments", "args"))
    result = text(first_of("o", "output"))
    events = _exploded(traces, TOOL_TYPES).selectExpr(
        "o", "doc_trace_id",
        *columns(
            tool_call_id="own_id",
            span_id="coalesce(nullif(parent_id, ''), own_id)",
            tool_name=text(one_of(layered("md", "tool_name"), first_of("o", "name"))),
            tool_type=text(layered("md", "tool_type"), "function"),
            arguments_json=f"coalesce(to_json({arguments}), '{{}}')",
            result_text=result,
            result_size=f"length({result})",
            duration_ms="coalesce(took, 0)",
            retry_count=integer(layered("md", "retry_count"), 0),
            region=text(layered("md", "region")),
            **_common(),
        ),
    )
    checks = obs.missing("agent_tool_call", _TOOL_REQUIRED) + [("duration_ms <= 0", "validity:non_positive_duration")]
    return _checked(events, checks, "observation", "o", "doc_trace_id", only_labels).drop("doc_trace_id")


def retrievals(traces: DataFrame, only_labels: bool = False) -> DataFrame:

    def m(*keys: str) -> str:
        return layered("md", *keys)

    output = variants(at("o", "output"))
    item_scores = f"transform({objects(output)}, x -> {first_of('x', 'score', 'similarity_score')})"
    given_scores = layered_variant(_OBJECTS, "similarity_scores", "scores")
    listed = f"if(({given_scores}) is not null, transform({variants(given_scores)}, x -> cast(x as string)), {item_scores})"
    with_scores = _exploded(traces, RETRIEVAL_TYPES).selectExpr(
        "*",
        f"filter(transform(coalesce({listed}, array()), x -> {real('x')}), x -> x >= 0) as sims",
        f"{text(one_of(first_of('o', 'input'), m('query', 'query_text')))} as query_text",
        f"coalesce({integer(one_of(m('returned_count', 'returned_cnt'), first_of('o', 'output.count')))}, "
        f"size({output}), 0) as returned",
    ).withColumn("returned", F.expr("if(returned = -1, 0, returned)"))

    def similarity(measure: str, name: str) -> str:
        return f"if(size(sims) > 0, {measure}, {real(m(name), 0.0)})"

    hits = m("hit_count", "hit_cnt")
    events = with_scores.selectExpr(
        "o", "doc_trace_id",
        *columns(
            retrieval_id="own_id",
            span_id="coalesce(nullif(parent_id, ''), own_id)",
            request_id=text(m("request_id")),
            app_name=text(m("app_name")),
            feature_name=f"coalesce({text(m('feature_name'), None)}, trace_name)",
            user_id="user_id",
            knowledge_base_id=text(m("knowledge_base_id", "kb_id")),
            knowledge_base_name=text(m("knowledge_base_name", "kb_name")),
            embedding_model=text(m("embedding_model")),
            retrieval_strategy=text(m("retrieval_strategy", "strategy")),
            query_text_hash=sha("query_text"),
            query_length="length(query_text)",
            top_k=integer(m("top_k"), 0),
            returned_count="returned",
            hit_count=f"if(({hits}) is null, returned, {integer(hits, 0)})",
            max_similarity_score=similarity("array_max(sims)", "max_similarity_score"),
            min_similarity_score=similarity("array_min(sims)", "min_similarity_score"),
            avg_similarity_score=similarity("aggregate(sims, 0D, (a, x) -> a + x) / size(sims)", "avg_similarity_score"),
            embedding_latency_ms=integer(m("embedding_latency_ms"), 0),
            search_latency_ms=f"if(({m('search_latency_ms')}) is null, coalesce(took, 0), {integer(m('search_latency_ms'), 0)})",
            total_latency_ms=(
                f"if(({m('total_latency_ms', 'latency_ms')}) is null, coalesce(took, 0), "
                f"{integer(m('total_latency_ms', 'latency_ms'), 0)})"
            ),
            **_common(),
        ),
    )
    checks = obs.missing("retrieval_request", _RETRIEVAL_REQUIRED) + [
        ("query_text_hash = ''", "completeness:missing_query_text"),
        ("top_k <= 0", "validity:non_positive_top_k"),
        ("returned_count < 0", "validity:negative_returned_count"),
        ("hit_count < 0", "validity:negative_hit_count"),
        ("hit_count > returned_count", "consistency:hit_count_exceeds_returned_count"),
        ("total_latency_ms <= 0", "validity:non_positive_total_latency"),
    ]
    return _checked(events, checks, "observation", "o", "doc_trace_id", only_labels).drop("doc_trace_id")


def embedded_scores(traces: DataFrame, only_labels: bool = False) -> DataFrame:
    """Scores of a trace with the trace's slim context, normalised."""
    context = ("id", "traceId", "trace_id", "name", "sessionId", "session_id", "userId", "user_id", "requestId",
               "request_id", "runId", "run_id", "projectName", "app_name", "feature_name", "environment", "env", "metadata")
    slim = ", ".join(f"'{name}', {at('t', name)}" for name in context)
    rows = _intact(traces, "t", "ss", where="size(ss) > 0")
    # Built once per trace, before its scores are exploded.
    with_context = rows.selectExpr(f"to_variant_object(named_struct({slim})) as t", "ss")
    return score_adapter.normalize(with_context.selectExpr("explode(ss) as s", "t"), only_labels)


def rejected_documents(traces: DataFrame) -> DataFrame:
    """Traces without usable envelope; nothing else is taken from them."""
    broken = settled(traces.select("r", "trace_id", F.col("envelope_errors").alias(ERRORS))).where(f"size({ERRORS}) > 0")
    labelled = broken.withColumn(STATUS, F.lit(REJECTED))
    source_id = F.expr(text(first_of("r", "id", "observationId", "traceId")))
    payload = F.expr("sha2(cast(r as string), 256)")
    return with_source_evidence(labelled, "langfuse", "trace", source_id, F.col("trace_id"), payload).drop("r")


def unparsable_documents(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines that hold no document."""
    return unparsable(lines, column, "langfuse", "trace")


def unsupported_observations(traces: DataFrame) -> DataFrame:
    """Observations of unknown type, labelled with the type."""
    rows = _intact(traces, "trace_id", "vs").selectExpr("trace_id", f"explode(filter(vs, v -> not {_in(_type('v'), KNOWN_TYPES)})) as o")
    kind = f"coalesce(nullif({_type('o')}, ''), 'missing')"
    labelled = rows.withColumn(ERRORS, F.expr(f"array(concat('validity:unsupported_observation_type:', {kind}))"))
    labelled = labelled.withColumn(STATUS, F.lit(REJECTED))
    source_id = F.expr(text(first_of("o", "id", "observationId", "traceId")))
    payload = F.expr("sha2(cast(o as string), 256)")
    return with_source_evidence(labelled, "langfuse", "observation", source_id, F.col("trace_id"), payload).drop("o")


_REJECT_COLUMNS = (
    "trace_id", ERRORS, STATUS, "_source_system", "_source_entity", "_source_id", "_source_trace_id", "_source_payload_hash",
)


def rejects(traces: DataFrame) -> DataFrame:
    """Every rejected part of the documents with its evidence."""
    parts = [part(traces, only_labels=True) for part in (runs, spans, tool_calls, retrievals, embedded_scores)]
    out = rejected_documents(traces).select(*_REJECT_COLUMNS).unionByName(
        unsupported_observations(traces).select(*_REJECT_COLUMNS)
    )
    for part in parts:
        out = out.unionByName(part.where(F.col(STATUS) == REJECTED).select(*_REJECT_COLUMNS))
    return out


def accepted(part: DataFrame, contract: FactContract) -> DataFrame:
    """Accepted rows of one part in contract shape."""
    rows = part.where(F.col(STATUS) == VALID)
    return rows.selectExpr(*[f"cast({f.name} as {f.type_name}) as {f.name}" for f in contract.fields])


def facts(traces: DataFrame) -> dict[str, DataFrame]:
    """All accepted facts by name."""
    scored = embedded_scores(traces)
    return {
        "agent_run": accepted(runs(traces), AGENT_RUN),
        "agent_span": accepted(spans(traces), AGENT_SPAN),
        "tool_call": accepted(tool_calls(traces), TOOL_CALL),
        "retrieval": accepted(retrievals(traces), RETRIEVAL),
        "feedback": score_adapter.feedback_actions(scored),
        "evaluation": score_adapter.evaluation_judgments(scored),
    }
