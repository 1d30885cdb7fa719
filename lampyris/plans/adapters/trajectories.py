"""Conversation trajectories to agent runs, spans and tool calls.

A trajectory is one JSON document.  Its turns are laid out as a flat array of
spans inside the row, so span order, the pairing of the k-th tool call with
the k-th tool message and all ids come from array positions without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from lampyris.contracts import AGENT_RUN, AGENT_SPAN, TOOL_CALL, FactContract
from lampyris.functions.documents import (
    at, columns, first_of, integer, layered, objects, one_of, parsed, real, spaced_json, text_map, unparsable, variants,
)

_STEP_MS = 100


def _filled(value: str) -> str:
    """Text, with empty text and zero counted as absent."""
    return f"if({value} in ('', '0', 'false'), null, {value})"


def _or(*values: str) -> str:
    return one_of(*[_filled(v) for v in values])


def _json_text(value: str) -> str:
    """A string as JSON text."""
    return f"substring(to_json(array({value})), 2, length(to_json(array({value}))) - 2)"


def _id(prefix: str, *json_parts: str) -> str:
    """Prefix and 32 hex digits of the hashed, |-joined JSON parts."""
    return f"concat('{prefix}_', substring(sha2(concat_ws('|', {', '.join(json_parts)}), 256), 1, 32))"


def documents(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per trajectory with its laid-out spans (array ``items``)."""
    opened = parsed(lines, column, "r").selectExpr(
        "r",
        f"{text_map('r', 'metadata')} as md",
        f"coalesce({objects(variants(at('r', 'conversations')))}, array()) as turns",
        f"{text_map('r', 'tool_error_counts')} as tool_errors",
    )

    def m(*keys: str) -> str:
        return _or(*[layered("md", k) for k in keys])

    said_by = "try_variant_get(x, '$.from', 'string')"
    said = "coalesce(try_variant_get(x, '$.value', 'string'), '')"
    whole = spaced_json("to_json(try_variant_get(r, '$.conversations', 'variant'))")
    fallback_run = _id("hermes_run", f"coalesce({first_of('r', 'prompt_index')}, 'null')", f"coalesce({whole}, '[]')")
    named = opened.selectExpr(
        "*",
        *columns(
            run_id=f"coalesce({m('session_id')}, {_or(first_of('r', 'session_id'))}, {fallback_run})",
            started=f"coalesce(try_cast({m('timestamp')} as timestamp), current_timestamp())",
            tool_texts=f"transform(filter(turns, x -> {said_by} = 'tool'), x -> {said})",
            human_texts=f"transform(filter(turns, x -> {said_by} = 'human'), x -> {said})",
            model_texts=f"transform(filter(turns, x -> {said_by} = 'gpt'), x -> {said})",
            done="coalesce(try_variant_get(r, '$.completed', 'boolean'), false) and "
            "not coalesce(try_variant_get(r, '$.partial', 'boolean'), false)",
        ),
    )
    calls = f"coalesce({objects(variants(at('x', 'tool_calls')))}, array())"
    reply = f"named_struct('i', i, 'j', -1, 'call', cast(null as variant), 'said', {said})"
    call = "named_struct('i', i, 'j', j, 'call', c, 'said', '')"
    flat = (
        f"flatten(transform(turns, (x, i) -> if({said_by} = 'gpt', "
        f"concat(array({reply}), transform({calls}, (c, j) -> {call})), array())))"
    )
    # Spans of one turn share its start: the trajectory start for the first
    # turn, later ones one step per span emitted before plus one.
    begins = f"if(x.i = 0, started, timestampadd(MILLISECOND, (p - x.j) * {_STEP_MS}, started))"
    placed = (
        "transform(flat, (x, p) -> named_struct('i', x.i, 'j', x.j, 'call', x.call, 'said', x.said, "
        f"'ord', p + 1, 'begins', {begins}))"
    )
    answer = "coalesce(get(tool_texts, k), '')"
    fields = "'i', x.i, 'j', x.j, 'call', x.call, 'said', {said}, 'ord', x.ord, 'begins', x.begins"
    laid = (
        named.selectExpr("*", f"{flat} as flat")
        .selectExpr("*", f"{placed} as placed")
        .selectExpr(
            "*",
            "filter(placed, x -> x.j < 0) as replies",
            f"transform(filter(placed, x -> x.j >= 0), (x, k) -> named_struct({fields.format(said=answer)})) as calls",
        )
        .drop("flat", "placed")
    )

    return laid.selectExpr(
        "*",
        *columns(
            trace_id=f"coalesce({m('trace_id')}, {_id('trace', _json_text('run_id'))})",
            agent_id=f"coalesce({m('agent_id')}, 'hermes_agent')",
            model=f"coalesce({m('model')}, '')",
            region=f"coalesce({m('region')}, 'unknown')",
            environment=f"coalesce({m('environment')}, 'dev')",
        ),
    )


def rejects(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines that hold no document."""
    return unparsable(lines, column, "hermes", "trajectory")


def runs(trajectories: DataFrame) -> DataFrame:
    def m(*keys: str) -> str:
        return _or(*[layered("md", k) for k in keys])

    steps = f"if(size(turns) = 0, 0, (size(replies) + size(calls) + 1) * {_STEP_MS})"
    toolsets = spaced_json("to_json(try_variant_get(r, '$.toolsets_used', 'variant'))")
    events = trajectories.selectExpr(
        *columns(
            run_id="run_id",
            trace_id="trace_id",
            agent_id="agent_id",
            agent_name=f"coalesce({m('agent_name')}, 'hermes_agent')",
            agent_version=f"coalesce({m('agent_version')}, 'unknown')",
            app_name=f"coalesce({m('app_name')}, 'hermes_agent')",
            user_id=f"coalesce({m('user_id')}, 'unknown_user')",
            session_id=f"coalesce({m('session_id')}, run_id)",
            conversation_id=f"coalesce({m('conversation_id')}, run_id)",
            task_type=f"coalesce({m('task_type')}, 'hermes_trajectory')",
            channel=f"coalesce({m('source', 'channel')}, 'batch')",
            toolsets_used=f"coalesce(nullif({toolsets}, 'null'), '[]')",
            input_text_hash="sha2(coalesce(get(human_texts, 0), ''), 256)",
            output_text_hash="sha2(coalesce(try_element_at(model_texts, -1), ''), 256)",
            start_time="started",
            end_time=f"timestampadd(MILLISECOND, {steps}, started)",
            duration_ms=steps,
            status="if(done, 'success', 'error')",
            error_type="if(done, null, 'incomplete_trajectory')",
            turn_count="size(human_texts)",
            llm_call_count=f"coalesce({integer(_or(first_of('r', 'api_calls')))}, size(replies))",
            tool_call_count="size(calls)",
            retrieval_count="0",
            total_tokens=f"coalesce({integer(one_of(m('total_tokens'), _or(first_of('r', 'total_tokens'))))}, 0)",
            estimated_cost_usd=f"coalesce({real(one_of(m('estimated_cost_usd'), _or(first_of('r', 'estimated_cost_usd'))))}, 0D)",
            mode="'hermes'",
            region="region",
            environment="environment",
            created_at="started",
            date="cast(started as date)",
        )
    )
    return _shaped(events, AGENT_RUN)


def _calls(trajectories: DataFrame) -> DataFrame:
    """One row per tool call with resolved name, arguments and outcome."""
    rows = trajectories.selectExpr(
        "run_id", "trace_id", "agent_id", "region", "environment", "tool_errors", "explode(calls) as x"
    )
    given = one_of(at("x.call", "function.arguments"), at("x.call", "arguments"))
    resolved = rows.selectExpr(
        "*",
        *columns(
            tool_name=f"coalesce({_or(first_of('x.call', 'function.name'), first_of('x.call', 'name'))}, 'unknown_tool')",
            arguments_json=(
                f"case when ({given}) is null then '{{}}' when schema_of_variant({given}) = 'STRING' "
                f"then cast({given} as string) else {spaced_json(f'to_json({given})')} end"
            ),
            reply_span=_id("span", _json_text("run_id"), "cast(x.i as string)", "'\"llm_call\"'"),
            own_span=_id("span", _json_text("run_id"), "cast(x.i as string)", "cast(x.j as string)", "'\"tool_call\"'"),
            own_call=_id("tool_call", _json_text("run_id"), "cast(x.i as string)", "cast(x.j as string)"),
        ),
    )
    counted = integer("try_element_at(tool_errors, tool_name)", 0)
    failed = f"{counted} > 0 or lower(x.said) rlike 'error|exception|traceback'"
    return resolved.selectExpr("*", f"{failed} as failed")


def spans(trajectories: DataFrame) -> DataFrame:
    shared = dict(
        run_id="run_id", trace_id="trace_id", agent_id="agent_id", span_order="x.ord", start_time="x.begins",
        end_time="x.begins", duration_ms="0", retry_count="0", output_size="length(x.said)", mode="'hermes'",
        region="region", environment="environment", created_at="x.begins", date="cast(x.begins as date)",
    )
    replies = trajectories.selectExpr(
        "run_id", "trace_id", "agent_id", "model", "region", "environment", "explode(replies) as x"
    ).selectExpr(
        *columns(
            span_id=_id("span", _json_text("run_id"), "cast(x.i as string)", "'\"llm_call\"'"),
            parent_span_id="cast(null as string)",
            span_name="'assistant_message'",
            span_type="'llm_call'",
            status="'success'",
            error_type="cast(null as string)",
            input_size="0",
            model_name="nullif(model, '')",
            tool_name="cast(null as string)",
            **shared,
        )
    )
    calls = _calls(trajectories).selectExpr(
        *columns(
            span_id="own_span",
            parent_span_id="reply_span",
            span_name="tool_name",
            span_type="'tool_call'",
            status="if(failed, 'error', 'success')",
            error_type="if(failed, 'tool_error', null)",
            input_size="length(arguments_json)",
            model_name="cast(null as string)",
            tool_name="tool_name",
            **shared,
        )
    )
    return _shaped(replies.unionByName(calls), AGENT_SPAN)


def tool_calls(trajectories: DataFrame) -> DataFrame:
    events = _calls(trajectories).selectExpr(
        *columns(
            tool_call_id=f"coalesce({_or(first_of('x.call', 'id'))}, own_call)",
            span_id="own_span",
            run_id="run_id",
            trace_id="trace_id",
            agent_id="agent_id",
            tool_name="tool_name",
            tool_type=f"coalesce({_or(first_of('x.call', 'type'))}, 'function')",
            arguments_json="arguments_json",
            result_text="x.said",
            result_size="length(x.said)",
            duration_ms="0",
            status="if(failed, 'error', 'success')",
            error_type="if(failed, 'tool_error', null)",
            retry_count="0",
            mode="'hermes'",
            region="region",
            environment="environment",
            created_at="x.begins",
            date="cast(x.begins as date)",
        )
    )
    return _shaped(events, TOOL_CALL)


def _shaped(events: DataFrame, contract: FactContract) -> DataFrame:
    return events.selectExpr(*[f"cast({f.name} as {f.type_name}) as {f.name}" for f in contract.fields])
