from datetime import date, datetime

from pyspark.sql import functions as F

from lampyris.contracts import CONTRACTS
from lampyris.functions.text import hashed_ip
from lampyris.operators import quality
from lampyris.operators.keyed import latest_by_key
from lampyris.plans import facts
from lampyris.sources import dimensions
from tests.builders import request, rows


def test_projection_types_defaults_and_dropped_text(spark):
    raw = spark.createDataFrame(
        [("r1", "12", "bad", "2026-01-05T09:00:00+00:00", "2026-01-05", "secret", None)],
        "request_id string, prompt_tokens string, latency_ms string, created_at string, date string, prompt_text string, trace_id string",
    )
    out = facts.typed(raw, "llm_request")
    assert out.schema == CONTRACTS["llm_request"].schema or out.columns == CONTRACTS["llm_request"].columns
    row = out.first()
    assert "prompt_text" not in out.columns
    assert (row.prompt_tokens, row.latency_ms, row.request_type, row.trace_id) == (12, None, "chat", None)
    assert (row.created_at, row.date) == (datetime(2026, 1, 5, 9), date(2026, 1, 5))
    assert facts.typed(raw, "llm_request", fill_nulls=True).first().trace_id == ""


def test_every_contract_projects_to_its_schema(spark):
    for name, contract in CONTRACTS.items():
        out = facts.typed(spark.createDataFrame([("x",)], f"{contract.key} string"), name)
        assert [f.dataType for f in out.schema] == [f.data_type for f in contract.fields]
        assert out.columns == contract.columns


def test_toolsets_default_to_empty_list(spark):
    raw = spark.createDataFrame([("r", None)], "run_id string, toolsets_used string")
    assert facts.typed(raw, "agent_run").first().toolsets_used == "[]"


def test_one_row_collects_every_broken_rule(spark):
    bad = request(prompt_tokens=-1, completion_tokens=-2, total_tokens=5, latency_ms=0, status="odd", estimated_cost_usd=-1, mode="x")
    checked = facts.validated(rows(spark, "llm_request", bad, request(2)), "llm_request")
    accepted, rejected = quality.split(checked)
    assert accepted.count() == 1 and "_dq_status" not in accepted.columns
    labels = rejected.first()._dq_errors
    assert labels == [
        "validity:negative_prompt_tokens", "validity:negative_completion_tokens", "consistency:token_total_mismatch",
        "validity:non_positive_latency", "validity:invalid_status", "validity:negative_cost", "validity:invalid_mode",
    ]
    assert {(r._dq_status, r.row_count) for r in quality.status_counts(checked).collect()} == {("valid", 1), ("quarantine", 1)}


def test_null_outcome_passes_in_batch_and_fails_in_stream(spark):
    frame = rows(spark, "llm_request", request(latency_ms=None))
    assert facts.valid(frame, "llm_request").count() == 1
    assert facts.valid(frame, "llm_request", null_fails=True).count() == 0
    assert facts.validated(frame, "llm_request", null_fails=True).first()._dq_errors == ["validity:non_positive_latency"]


def test_cost_estimate_uses_list_price_or_default(spark):
    frame = rows(
        spark, "llm_request", request(1, model_name="deepseek-v4-pro", prompt_tokens=1_000_000, completion_tokens=0),
        request(2, model_name="other", prompt_tokens=0, completion_tokens=500_000),
    )
    out = facts.with_estimated_cost(frame, dimensions.model_dimension(spark))
    assert {r.request_id: r.estimated_cost_usd for r in out.collect()} == {"r1": 0.435, "r2": 0.14}


def test_ip_hash_is_salted(spark):
    import hashlib

    row = spark.range(1).select(hashed_ip(F.lit("10.0.0.1"), "pepper").alias("h")).first()
    assert row.h == hashlib.sha256(b"pepper:10.0.0.1").hexdigest() and len(row.h) == 64


def test_latest_row_per_key(spark):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)], "k string, v int, t string")
    assert sorted(latest_by_key(frame, ["k"], ["v"]).collect()) == [("a", 3, "z"), ("b", 1, None)]


def test_dimensions_have_rows(spark):
    for build, n in (
        (dimensions.model_dimension, 4), (dimensions.model_version_dimension, 4), (dimensions.prompt_version_dimension, 3),
        (dimensions.team_dimension, 3), (dimensions.user_dimension, 6), (dimensions.sla_rules, 5),
        (dimensions.platform_thresholds, 11),
    ):
        assert build(spark).count() == n
