"""Adapters on invented documents: a city library's reading assistant, written from the rules of the data model."""

import hashlib
import json

from lampyris.contracts import CONTRACTS
from lampyris.plans import facts
from lampyris.plans.adapters import generations, scores, traces, trajectories

DAY = "2031-03-09"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def compact(value):
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def at(clock):
    return f"{DAY}T{clock}Z"


def lines(spark, *docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value string")


def only(frame):
    (row,) = frame.collect()
    return row


# --- generations --------------------------------------------------------------


def generation(**changes):
    doc = {
        "generationId": "loan-77", "trace_id": "visit-8", "startTime": at("17:20:05.250"), "endTime": at("17:20:07.000"),
        "modelName": "reader-small", "prompt": "Which shelf holds atlases?", "completion": {"shelf": "R4", "floor": 2},
        "usage": {"promptTokens": 311, "completionTokens": 29}, "totalCost": None,
        "trace": {"name": "catalogue", "userId": "card-5", "sessionId": "desk-2", "metadata": {"region": "north", "provider": "shared"}},
        "metadata": {
            "app_name": "library", "environment": "prod", "provider": "house", "prompt_category": "search", "prompt_name": "shelf",
            "prompt_version": "v12",
        },
    }
    return doc | changes


def normalized(spark, *docs, **options):
    return generations.normalize(lines(spark, *docs), **options)


def test_aliases_of_a_generation(spark):
    row = only(generations.requests(normalized(spark, generation())))
    assert (row.request_id, row.trace_id, row.span_id) == ("loan-77", "visit-8", "loan-77")
    assert (row.model_name, row.prompt_id, row.feature_name, row.user_id, row.session_id) == ("reader-small", "shelf", "catalogue", "card-5", "desk-2")
    # The record's own metadata hides the trace's.
    assert (row.provider, row.region) == ("house", "north")
    assert (row.prompt_tokens, row.completion_tokens, row.total_tokens, row.latency_ms) == (311, 29, 340, 1750)
    assert (row.prompt_hash, row.input_chars) == (sha("Which shelf holds atlases?"), 26)
    assert row.response_hash == sha('{"floor":2,"shelf":"R4"}')
    assert (row.estimated_cost_usd, row.estimated_cost_source, row.mode, str(row.date)) == (0.0, "default_zero", "replay", DAY)


def test_failed_generation_takes_its_defaults(spark):
    doc = generation(level="FATAL", modelParameters={"temperature": 0.65, "maxTokens": 90})
    doc["metadata"] |= {"retry_count": "4", "streaming": "y", "estimated_cost_usd": 1.25e-7, "status_code": 503}
    row = only(generations.requests(normalized(spark, doc)))
    assert (row.status, row.http_status, row.finish_reason, row.retry_count) == ("error", 503, "error", 4)
    assert (row.is_streaming, row.temperature, row.max_tokens) == (True, 0.65, 90)
    assert (row.estimated_cost_usd, row.estimated_cost_source) == (1.25e-7, "metadata_estimate")


def test_fractions_are_cut_in_numbers_and_refused_in_text(spark):
    cut = only(generations.requests(normalized(spark, generation(usage={"promptTokens": 80.9, "completionTokens": "7"}))))
    assert (cut.prompt_tokens, cut.completion_tokens, cut.total_tokens) == (80, 7, 87)
    row = only(generations.rejects(normalized(spark, generation(usage={"promptTokens": "80.9", "completionTokens": 7}))))
    assert "completeness:missing_prompt_tokens" in row._dq_errors


def test_the_same_payload_counts_once(spark):
    doc = generation()
    shuffled = json.dumps({k: doc[k] for k in sorted(doc, reverse=True)}, indent=0).replace("\n", "")
    other = generation(generationId="loan-78")
    assert normalized(spark, shuffled, other, doc, doc).count() == 2
    assert normalized(spark, shuffled, other, doc, doc, deduplicate=False).count() == 4


def test_payloads_that_differ_in_spelling_only_give_one_row_of_the_same_values(spark):
    doc = generation(id="a", totalCost=0.5, modelParameters={"temperature": 0.25, "maxTokens": 64}, usage={"promptTokens": 80.9, "completionTokens": 7})
    plain = json.dumps(doc)
    spelt = plain.replace("80.9", "80.900").replace("0.25", "0.2500").replace('"id": "a"', '"id":  "\\u0061"').replace("0.5", "0.50")
    assert spelt != plain
    alone = [only(generations.requests(normalized(spark, d))) for d in (plain, spelt)]
    assert alone[0] == alone[1] == only(generations.requests(normalized(spark, plain, spelt, spelt)))


def test_values_of_other_kinds_are_absent_or_text(spark):
    doc = generation(trace="none", metadata=[1], usage="many", usageDetails={"input": 5, "output": None}, model={"b": 1, "a": [2]}, id=7.50)
    row = only(normalized(spark, doc))
    assert (row.request_id, row.model_name, row.prompt_tokens, row.completion_tokens) == ("7.5", '{"a":[2],"b":1}', 5, None)
    assert (row.user_id, row.feature_name, row.region, row.environment) == ("", "", "", "")
    for text in ("[1]", "5", '"x"', "null"):
        row = only(normalized(spark, text))
        assert "validity:unparsable_document" not in row._dq_errors and "completeness:missing_request_id" in row._dq_errors


def test_a_generation_is_parsed_and_read_once(spark):
    """Every path read on its own walks the document again; 36 million documents did not fit the time so."""
    spark.conf.set("spark.sql.debug.maxToStringFields", 10_000)
    plans = [
        str(frame._jdf.queryExecution().optimizedPlan().toString())
        for frame in (generations.requests(normalized(spark, generation())), generations.rejects(normalized(spark, generation(), only_labels=True)))
    ]
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert [(plan.count("variant_get("), plan.count("parseJson")) for plan in plans] == [(1, 1)] * 2


def test_rejected_generations_name_every_fault(spark):
    doc = generation(type="SPAN", endTime=at("17:20:05.250"), usage={"promptTokens": -3, "completionTokens": 4, "totalTokens": 5})
    doc["trace"] = {"metadata": {"provider": "shared"}}
    row = only(generations.rejects(normalized(spark, doc)))
    assert row._dq_errors == [
        "completeness:missing_user_id", "completeness:missing_session_id", "completeness:missing_feature_name",
        "completeness:missing_region", "validity:negative_prompt_tokens", "consistency:token_total_mismatch",
        "validity:non_positive_latency", "validity:unsupported_observation_type",
    ]
    assert (row._source_system, row._source_entity, row._source_id) == ("langfuse", "generation", "loan-77")
    assert not {"prompt", "completion", "input_text", "output_text"} & set(row.asDict())


def test_text_that_is_no_document_is_a_reject(spark):
    rows = generations.rejects(normalized(spark, "", "{'single': 1}", '{"a":1,"a":2}', generation())).collect()
    assert [r._dq_errors for r in rows] == [["validity:unparsable_document"]] * 3
    assert len({r._source_payload_hash for r in rows}) == 3


def test_an_explicit_null_hides_the_lower_layer(spark):
    doc = generation()
    doc["metadata"]["region"] = None
    assert only(generations.rejects(normalized(spark, doc)))._dq_errors == ["completeness:missing_region"]


# --- scores -------------------------------------------------------------------


def score(**changes):
    return {
        "id": "s", "requestId": "loan-1", "timestamp": at("08:00:00"), "metadata": {"app_name": "library", "feature_name": "catalogue"},
    } | changes


def scored(spark, *docs):
    return scores.normalize(scores.standalone(lines(spark, *docs)))


def test_reader_reactions_become_feedback(spark):
    given = [("like", "thumbs_up"), ("dislike", "thumbs_down"), ("retry", "regenerate"), ("FLAGGED", "report"), ("edit", "edit")]
    out = scored(spark, *[score(id=f"s{i}", source="user", name=name, value=i) for i, (name, _) in enumerate(given)])
    assert {r.feedback_id: r.feedback_type for r in scores.feedback_actions(out).collect()} == {f"s{i}": kind for i, (_, kind) in enumerate(given)}
    said = only(scores.feedback_actions(scored(spark, score(source="USER", name="like", value=1, comment="fünf Sterne"))))
    assert (said.feedback_text_hash, said.feedback_text_length) == (sha("fünf Sterne"), 11)


def test_stars(spark):
    # Shares of one map to round-half-even(4v) + 1; whole stars stay; the rest is cut off.
    given = {"p": 0.375, "q": 0.125, "r": 0.26, "s": 2, "t": 5, "u": 11.5}
    out = scored(spark, *[score(id=k, source="MANUAL", name="rating", value=v) for k, v in given.items()])
    assert {r.score_id: r.rating_value for r in out.collect()} == {"p": 3, "q": 1, "r": 2, "s": 2, "t": 5, "u": 11}


def test_judgments_become_evaluations(spark):
    out = scored(
        spark,
        score(id="j1", source="EVALUATOR", name="coherence", value=0.55, config={"passThreshold": 0.55, "evaluatorType": "judge"}),
        score(id="j2", source="DATASET_RUN", name="faithfulness", value=0.2, config={"datasetRunId": "run-3"}),
        score(id="j3", source="AUTOMATED", name="toxicity", value=-0.1),
    )
    got = {r.evaluation_id: r for r in scores.evaluation_judgments(out).collect()}
    assert set(got) == {"j1", "j2"}
    assert (got["j1"].evaluator_type, got["j1"].evaluation_dimension, got["j1"].passed) == ("llm_judge", "coherence", True)
    assert (got["j2"].evaluator_type, got["j2"].score, got["j2"].passed) == ("ground_truth", 0.2, False)
    assert only(scores.rejects(out))._dq_errors == ["validity:invalid_score_range"]


def test_scores_without_a_class_or_target(spark):
    bare = {"id": "n1", "source": "EVALUATOR", "name": "relevance", "value": 0.4, "timestamp": at("08:00:00")}
    out = scored(
        spark, {"id": "n0", "value": 3}, bare, score(id="n2", source="USER", name="coherence", value=1), score(id="n3", source="API", name="speed", value=1),
    )
    assert {r.score_id: r._dq_errors for r in out.collect()} == {
        "n0": ["completeness:missing_score_classification"],
        "n1": ["completeness:missing_score_target"],
        "n2": ["consistency:conflicting_score_classification"],
        "n3": ["validity:unknown_score_classification"],
    }


def test_a_score_without_id_is_named_by_its_content(spark):
    doc = score(source="USER", name="like", value=1)
    del doc["id"]
    assert only(scored(spark, doc)).score_id == "score_" + sha(compact(doc))[:16]


def test_scores_that_are_no_documents(spark):
    assert only(scores.unparsable_documents(lines(spark, score(), "nothing")))._source_entity == "score_event"


# --- traces -------------------------------------------------------------------


def journey(**changes):
    """One visit: a step with two tools and a search under it, an answer, a reaction and a judgment."""
    doc = {
        "id": "visit-8", "name": "catalogue", "userId": "card-5", "sessionId": "desk-2", "input": "Maps of 1890?", "output": "Room R4.",
        "metadata": {
            "agent_run_id": "round-4", "agent_task_type": "lookup", "agent_id": "guide", "agent_name": "Guide", "app_name": "library",
            "env": "prod", "turn_count": 6,
        },
        "observations": [
            {"id": "step-b", "type": "CHAIN", "name": "shelve", "parentObservationId": "step-a", "startTime": at("10:00:02.000"), "metadata": {"duration_ms": 640}},
            {"id": "step-a", "type": "SPAN", "name": "visit", "startTime": at("10:00:00.000"), "endTime": at("10:00:04.000")},
            {"id": "tool-x", "type": "TOOL", "name": "stamp", "startTime": at("10:00:01.000"), "endTime": at("10:00:01.090"), "input": {"b": 2, "a": [1]}, "output": "stamped"},
            {"id": "tool-y", "type": "TOOL", "name": "fetch", "startTime": at("10:00:01.500"), "endTime": at("10:00:01.810"), "level": "ERROR"},
            {"id": "find-1", "type": "RETRIEVER", "parentObservationId": "step-a", "startTime": at("10:00:00.500"), "endTime": at("10:00:00.730"), "input": "maps",
             "output": [{"score": 0.25}, {"score": 0.75}, {"score": 0.5}],
             "metadata": {"knowledge_base_id": "stacks", "embedding_model": "glyph", "retrieval_strategy": "vector", "top_k": 8}},
            {"id": "say-1", "type": "GENERATION", "startTime": at("10:00:03.000"), "usageDetails": {"total": 903}, "costDetails": {"total": 0.0375}},
        ],
        "scores": [
            {"id": "mood", "source": "USER", "name": "dislike", "observationId": "say-1", "timestamp": at("10:05:00"), "value": 0},
            {"id": "mark", "source": "AUTOMATED", "name": "hallucination", "timestamp": at("10:05:01"), "value": 0.125},
        ],
    }
    return doc | changes


def opened(spark, *docs):
    return traces.documents(lines(spark, *docs))


def test_a_trace_gives_all_facts(spark):
    docs = opened(spark, journey())
    got = {name: frame.collect() for name, frame in traces.facts(docs).items()}
    run = got["agent_run"][0]
    assert (run.run_id, run.task_type, run.turn_count, run.duration_ms) == ("round-4", "lookup", 6, 4000)
    assert (run.llm_call_count, run.tool_call_count, run.retrieval_count) == (1, 2, 1)
    assert (run.total_tokens, run.estimated_cost_usd, run.input_text_hash) == (903, 0.0375, sha("Maps of 1890?"))
    assert sorted(json.loads(run.toolsets_used)) == ["fetch", "stamp"]
    spans = {r.span_id: r for r in got["agent_span"]}
    assert {i: (s.span_order, s.parent_span_id, s.span_type) for i, s in spans.items()} == {"step-b": (1, "step-a", "chain"), "step-a": (2, None, "span")}
    assert spans["step-b"].duration_ms == 640
    tools = {r.tool_call_id: r for r in got["tool_call"]}
    assert (tools["tool-x"].arguments_json, tools["tool-x"].duration_ms, tools["tool-x"].result_size) == ('{"a":[1],"b":2}', 90, 7)
    assert (tools["tool-x"].status, tools["tool-y"].status, tools["tool-y"].duration_ms) == ("success", "error", 310)
    search = got["retrieval"][0]
    assert (search.returned_count, search.hit_count, search.top_k, search.total_latency_ms) == (3, 3, 8, 230)
    assert (search.min_similarity_score, search.max_similarity_score, search.avg_similarity_score) == (0.25, 0.75, 0.5)
    assert (search.query_text_hash, search.span_id) == (sha("maps"), "step-a")
    assert (got["feedback"][0].feedback_type, got["feedback"][0].trace_id) == ("thumbs_down", "visit-8")
    assert (got["evaluation"][0].score, got["evaluation"][0].evaluator_type) == (0.125, "classifier")
    assert facts.valid(traces.facts(docs)["retrieval"], "retrieval").count() == 1
    assert traces.rejects(docs).count() == 0


def test_a_nested_trace_without_run(spark):
    inner = journey(metadata={"app_name": "library"}, observations=None, scores=None)
    docs = opened(spark, {"trace": inner, "observations": journey()["observations"][1:2]})
    envelope = only(traces.envelopes(docs))
    assert (envelope.trace_id, envelope.run_id, envelope.has_run_metadata, envelope.observation_count) == ("visit-8", "", False, 1)
    assert traces.runs(docs).count() == 0
    assert only(traces.accepted(traces.spans(docs), CONTRACTS["agent_span"])).span_id == "step-a"


def test_parts_of_a_trace_are_rejected_one_by_one(spark):
    odd = [
        {"id": "o1", "startTime": at("10:00:00.000")},
        {"id": "o2", "type": "Guardrail", "startTime": at("10:00:00.000")},
        {"id": "o3", "type": "RETRIEVER", "startTime": at("10:00:00.000"), "endTime": at("10:00:00.500"), "metadata": {"top_k": 2}},
    ]
    got = {r._source_id: r._dq_errors for r in traces.rejects(opened(spark, {"id": "empty"}, journey(observations=odd, scores=[]))).collect()}
    assert got["o1"] == ["validity:unsupported_observation_type:missing"]
    assert got["o2"] == ["validity:unsupported_observation_type:guardrail"]
    assert {"completeness:missing_query_text", "completeness:missing_retrieval_request_retrieval_strategy"} <= set(got["o3"])
    assert got["empty"] == ["completeness:missing_trace_envelope_created_at", "completeness:missing_trace_envelope_date"]


def test_accepted_rows_do_not_hash_their_payload(spark):
    """Evidence is for rejects: queries of accepted rows must not pay for it."""
    accepted = traces.accepted(traces.spans(opened(spark, journey())), CONTRACTS["agent_span"])
    spark.conf.set("spark.sql.debug.maxToStringFields", 10_000)
    plan = accepted._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert "sha2" not in plan and "Generate inline" in plan


def test_lists_of_a_trace_come_from_the_first_name_that_holds_a_value(spark):
    two = journey()["observations"][:2]
    docs = opened(
        spark, {"trace": journey(id="a", observations=two), "observations": "none", "scores": None}, {"trace": journey(id="b", observations=two), "observations": None},
        journey(id="c", observations=[*two, 1, None, []], scores={}),
    )
    assert {r.trace_id: (len(r.vs), len(r.ss)) for r in docs.selectExpr("trace_id", "transform(vs, v -> 1) as vs", "transform(ss, v -> 1) as ss").collect()} == {
        "a": (0, 2), "b": (2, 2), "c": (2, 0)}


# --- trajectories ---------------------------------------------------------------


def named(prefix, *parts):
    return f"{prefix}_" + sha("|".join(json.dumps(p, sort_keys=True, ensure_ascii=False) for p in parts))[:32]


def trajectory(**changes):
    doc = {
        "prompt_index": 9,
        "conversations": [
            {"from": "human", "value": "Renew my loan"},
            {"from": "gpt", "value": "Looking", "tool_calls": [{"name": "loans", "arguments": {"card": "5"}}]},
            {"from": "tool", "value": "one loan"},
            {"from": "gpt", "value": "Renewing", "tool_calls": [
                {"id": "c-2", "function": {"name": "renew", "arguments": '{"loan": 77}'}},
                {"id": "c-3", "function": {"arguments": None}}]},
            {"from": "tool", "value": "Error: blocked"},
        ],
        "metadata": {"timestamp": f"{DAY}T06:00:00Z", "session_id": "desk-9", "model": "reader-large"},
        "completed": True, "toolsets_used": ["desk"], "api_calls": 3,
    }
    return doc | changes


def laid_out(spark, *docs):
    return trajectories.documents(lines(spark, *docs))


def test_a_trajectory_is_laid_out_in_order(spark):
    docs = laid_out(spark, trajectory())
    run = only(trajectories.runs(docs))
    assert (run.run_id, run.turn_count, run.llm_call_count, run.tool_call_count, run.duration_ms) == ("desk-9", 1, 3, 3, 600)
    assert (run.status, run.toolsets_used, run.trace_id) == ("success", '["desk"]', named("trace", "desk-9"))
    spans = sorted(trajectories.spans(docs).collect(), key=lambda r: r.span_order)
    assert [s.span_type for s in spans] == ["llm_call", "tool_call", "llm_call", "tool_call", "tool_call"]
    assert spans[1].span_id == named("span", "desk-9", 1, 0, "tool_call")
    assert spans[3].parent_span_id == spans[2].span_id == named("span", "desk-9", 3, "llm_call")
    calls = {r.tool_name: r for r in trajectories.tool_calls(docs).collect()}
    assert (calls["loans"].arguments_json, calls["loans"].result_text) == ('{"card": "5"}', "one loan")
    assert calls["loans"].tool_call_id == named("tool_call", "desk-9", 1, 0)
    assert (calls["renew"].tool_call_id, calls["renew"].status, calls["renew"].arguments_json) == ("c-2", "error", '{"loan": 77}')
    # The third call has no name, no arguments and no answer.
    assert (calls["unknown_tool"].tool_call_id, calls["unknown_tool"].result_text) == ("c-3", "")


def test_an_unnamed_and_unfinished_trajectory(spark):
    doc = trajectory(metadata={"timestamp": f"{DAY}T06:00:00Z"}, partial=True, tool_error_counts={"loans": 1})
    docs = laid_out(spark, doc)
    run = only(trajectories.runs(docs))
    assert run.run_id == named("hermes_run", 9, doc["conversations"])
    assert (run.status, run.error_type) == ("error", "incomplete_trajectory")
    assert {r.tool_name: r.status for r in trajectories.tool_calls(docs).collect()}["loans"] == "error"


def test_trajectories_that_are_no_documents(spark):
    assert only(trajectories.rejects(lines(spark, trajectory(), "{")))._dq_errors == ["validity:unparsable_document"]
