"""Continuous summaries of two facts against the batch ones, with late conflicts, evaluations and feedback."""

from datetime import date, datetime, timedelta

from lampyris.contracts import CONTRACTS
from lampyris.plans import summaries
from lampyris.streaming import joins
from tests.builders import request, rows


def _streams(spark, path, facts):
    """One stream per fact over files that were written one batch after the other."""
    out = []
    for name, batches in facts.items():
        for place, frame in enumerate(batches):
            frame.coalesce(1).write.mode("append").parquet(f"{path}/{name}/b{place}")
        schema = CONTRACTS[name].schema
        out.append(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{path}/{name}"))
    return out


def _same(got, want):
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_late_conflicts_and_evaluations_take_back_what_was_attributed(spark, path):
    ask = lambda i, version, **kw: request(i, prompt_id="p", prompt_version=version, model_name="m") | kw
    judge = lambda i, request_id, **kw: {"evaluation_id": f"e{i}", "request_id": request_id, "score": i / 7, "passed": i % 2 == 0, "evaluated_prompt_version": "v9", "evaluated_model_name": "m9"} | kw
    asked = [
        [ask(1, "v1"), ask(2, "v1"), ask(3, "v2"), ask(4, "")],
        [ask(1, "v1"), ask(2, "v2")],  # request 2 is in conflict now
        [ask(5, "v1"), ask(6, "v2", request_id=" "), ask(3, "v2", date=date(2026, 1, 6))],
    ]
    judged = [
        [judge(1, "r1"), judge(2, "r2"), judge(3, "r5"), judge(4, " ")],
        [judge(5, "r3"), judge(6, "r2", score=None), judge(7, "r1", passed=None)],  # r2 was judged before and after its conflict
        [judge(8, "r4"), judge(9, "r3", date=date(2026, 1, 6)), judge(10, "none"), judge(11, "r1", evaluated_prompt_version=None)],
    ]
    batches = {"llm_request": [rows(spark, "llm_request", *b) for b in asked], "evaluation": [rows(spark, "evaluation", *b) for b in judged]}
    streams = _streams(spark, path, batches)
    for query in joins.start_prompt_versions(*streams, f"{path}/stores", f"{path}/summary", f"{path}/check"):
        query.awaitTermination()
        assert query.exception() is None
    want = summaries.prompt_version_daily(rows(spark, "llm_request", *sum(asked, [])), rows(spark, "evaluation", *sum(judged, [])))
    _same(spark.read.parquet(f"{path}/summary"), want)
    assert want.agg({"metadata_conflict_cnt_1d": "sum"}).first()[0] == 2


def test_sessions_grow_and_are_resolved_late(spark, path):
    at = datetime(2026, 1, 5, 9)
    turn = lambda i, session, **kw: request(i, session_id=session, created_at=at + timedelta(seconds=i), latency_ms=i * 7 % 50 + 1, total_tokens=i) | kw
    praise = lambda i, session, **kw: {"feedback_id": f"f{i}", "session_id": session, "feedback_type": "rating", "rating_value": 3 + i % 3} | kw
    asked = [
        [turn(1, "a"), turn(2, "b"), turn(3, None)],
        [turn(40, "a"), turn(5, "c", total_tokens=None)],
        [turn(6, "d", date=date(2026, 1, 6)), turn(0, "a")],
    ]
    told = [[praise(1, "a"), praise(0, "b"), praise(2, "c")], [praise(1, None), praise(4, "d", date=date(2026, 1, 6))], [praise(2, "b", feedback_type="thumbs_up")]]
    batches = {"llm_request": [rows(spark, "llm_request", *b) for b in asked], "feedback": [rows(spark, "feedback", *b) for b in told]}
    streams = _streams(spark, path, batches)
    query = joins.start_sessions(*streams, f"{path}/sums", f"{path}/summary", f"{path}/check")
    query.awaitTermination()
    assert query.exception() is None
    want = summaries.session_daily(rows(spark, "llm_request", *sum(asked, [])), rows(spark, "feedback", *sum(told, [])))
    _same(spark.read.parquet(f"{path}/summary"), want)
