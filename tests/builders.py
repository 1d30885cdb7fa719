"""Small rows for unit tests: give what matters, the rest takes defaults."""

from __future__ import annotations

from datetime import date, datetime

from lampyris.contracts import CONTRACTS


def rows(spark, fact: str, *given: dict):
    contract = CONTRACTS[fact]
    fixed = {
        "date": date(2026, 1, 5), "created_at": datetime(2026, 1, 5, 9), "mode": "mock", "environment": "dev",
        "region": "us", "status": "success", "app_name": "app", "feature_name": "chat", "model_name": "m",
        "provider": "p", "user_id": "u1", "session_id": "s1", "prompt_id": "p1", "prompt_version": "v1",
        "agent_id": "a1", "agent_name": "agent", "task_type": "t",
    }
    out = []
    for row in given:
        values = []
        for f in contract.fields:
            value = row.get(f.name, fixed.get(f.name, f.default if f.has_default else None))
            values.append(float(value) if f.type_name == "double" and value is not None else value)
        out.append(tuple(values))
    return spark.createDataFrame(out, contract.schema)


def request(i: int = 1, **kw) -> dict:
    base = dict(
        request_id=f"r{i}", trace_id=f"t{i}", prompt_tokens=10, completion_tokens=5, total_tokens=15, latency_ms=100,
        estimated_cost_usd=0.01, http_status=200,
    )
    return base | kw
