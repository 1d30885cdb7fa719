import glob
import json
import os
from datetime import date, datetime

from pyspark.sql import functions as F

from lampyris.contracts import CONTRACTS
from lampyris.plans import backfill, facts, summaries
from lampyris.sources import dimensions, readers, writers
from tests.builders import request, rows


def _events(path, *events):
    with open(path, "w") as out:
        out.writelines((e if isinstance(e, str) else json.dumps(e)) + "\n" for e in events)


def _raw(i, day, **kw):
    base = request(i, date=day, created_at=f"{day}T09:00:00+00:00", app_name="a", feature_name="f", model_name="m", status="success",
                   mode="live", user_id="u", session_id="s", prompt_text="never stored")
    return base | kw


def test_backfill_counts_and_reruns(spark, path):
    source, store = f"{path}/in.jsonl", f"{path}/wh"
    _events(source, _raw(1, "2026-01-05"), _raw(2, "2026-01-06", latency_ms=0), _raw(3, "2026-01-06"), _raw(4, "2026-02-01"))
    expected = {"input_rows": 3, "fact_rows": 2, "summary_rows": 2, "quarantine_rows": 1}
    assert backfill.backfill_requests(spark, source, store, "2026-01-01", "2026-01-31") == expected
    before = sorted(spark.read.parquet(f"{store}/feature_daily").collect())
    assert backfill.backfill_requests(spark, source, store, "2026-01-06", "2026-01-06")["fact_rows"] == 1
    # Re-running one day replaces that day only.
    assert sorted(spark.read.parquet(f"{store}/feature_daily").collect()) == before
    schema = CONTRACTS["llm_request"].schema
    stored = writers.read_valid(spark, f"{store}/llm_request", schema)
    assert stored.count() == 2 and "prompt_text" not in stored.columns
    rejected = writers.read_rejected(spark, f"{store}/llm_request", schema).collect()
    assert [r._dq_errors for r in rejected] == [["validity:non_positive_latency"]]
    ledger = spark.read.json(f"{store}/pipeline_runs")
    # Both runs cover the day of the rejected row.
    assert sorted(tuple(r) for r in ledger.select("input_rows", "output_rows", "quarantine_rows").collect()) == [(2, 1, 1), (3, 2, 1)]


def test_reload_replaces_valid_and_rejected_rows_together(spark, path):
    schema = CONTRACTS["llm_request"].schema
    day = dict(date=date(2026, 1, 5))
    both = [request(1, latency_ms=0, **day), request(2, **day)]
    writers.write_validated(facts.validated(rows(spark, "llm_request", *both), "llm_request"), path)
    assert (writers.read_valid(spark, path, schema).count(), writers.read_rejected(spark, path, schema).count()) == (1, 1)
    mended = [request(1, **day), request(2, **day)]
    counts = writers.write_validated(facts.validated(rows(spark, "llm_request", *mended), "llm_request"), path)
    assert counts == {"input_rows": 2, "valid_rows": 2, "rejected_rows": 0}
    assert (writers.read_valid(spark, path, schema).count(), writers.read_rejected(spark, path, schema).count()) == (2, 0)


def test_date_range_prunes_partitions(spark, path):
    frame = rows(spark, "llm_request", request(1, date=date(2026, 1, 5)), request(2, date=date(2026, 1, 9)))
    writers.overwrite_dates(frame, path)
    out = readers.between_dates(spark.read.parquet(path), "2026-01-05", "2026-01-06")
    assert [r.request_id for r in out.collect()] == ["r1"]
    assert "PartitionFilters: [isnotnull(date" in out._jdf.queryExecution().executedPlan().toString()


def test_export_layout(spark, path):
    raw = spark.createDataFrame([("r1", None, "a\tb", "5")], "request_id string, error_type string, prompt_text string, prompt_tokens string")
    writers.export_request_rows(raw, path)
    # Partitions without rows may leave empty files beside the one that counts.
    line = "".join(open(part).read() for part in glob.glob(f"{path}/part-*")).rstrip("\n")
    assert len(writers.EXPORT_COLUMNS) == 42
    cells = line.replace('"a\tb"', "QUOTED").split("\t")
    by_name = dict(zip(writers.EXPORT_COLUMNS, cells))
    assert (by_name["request_id"], by_name["prompt_text"], by_name["error_type"]) == ("r1", "QUOTED", r"\N")
    assert (by_name["trace_id"], by_name["is_streaming"], by_name["request_type"], by_name["user_id"]) == ("", "false", "chat", r"\N")


def test_publish_orders_columns_and_types_dates(spark, path):
    daily = summaries.feature_daily(rows(spark, "llm_request", request(1)))
    text_dates = daily.withColumn("date", F.col("date").cast("string")).withColumn("extra", F.lit(1))
    writers.publish_files(text_dates, "feature_daily", path)
    out = spark.read.parquet(path)
    assert tuple(out.columns) == writers.PUBLISHED_COLUMNS["feature_daily"]
    assert dict(out.dtypes)["date"] == "date"


def test_snapshot_and_catalog_scan(spark, path):
    writers.overwrite_all(dimensions.model_dimension(spark), path)
    spark.read.parquet(path).createOrReplaceTempView("models_snapshot")
    assert readers.catalog_table(spark, "models_snapshot").count() == 4


def test_domains_load_in_one_session(spark, path):
    raw = {
        "llm_request": rows(spark, "llm_request", request(1)),
        "feedback": rows(spark, "feedback", dict(feedback_id="f", feedback_type="odd", response_latency_ms=1),
                         dict(feedback_id="g", feedback_type="edit", response_latency_ms=1)),
    }
    counts = backfill.load_domains(spark, raw, path)
    assert counts["feedback"] == {"input_rows": 2, "valid_rows": 1, "rejected_rows": 1}
    assert spark.read.parquet(f"{path}/feedback_daily").first().feedback_cnt_1d == 1


def test_document_imports(spark, path):
    from tests.test_adapters import generation, trajectory

    _events(f"{path}/g.jsonl", generation(), generation(), generation(id="g2", type="SPAN"))
    counts = backfill.import_generations(spark, f"{path}/g.jsonl", f"{path}/ok", f"{path}/bad")
    assert counts == {"input_rows": 3, "output_rows": 1, "quarantine_rows": 1}
    assert facts.valid(spark.read.parquet(f"{path}/ok"), "llm_request").count() == 1
    _events(f"{path}/t.jsonl", trajectory(), "[broken")
    assert backfill.import_trajectories(spark, f"{path}/t.jsonl", f"{path}/t") == {"runs": 1, "spans": 5, "tool_calls": 3, "rejects": 1}


def test_every_document_is_accounted_for(spark, path):
    from tests.test_adapters import generation

    _events(f"{path}/g.jsonl", generation(), '{"id": "twice", "id": "twice"}', "no json at all", generation())
    counts = backfill.import_generations(spark, f"{path}/g.jsonl", f"{path}/ok", f"{path}/bad")
    assert counts == {"input_rows": 4, "output_rows": 1, "quarantine_rows": 2}
    rejected = spark.read.parquet(f"{path}/bad").collect()
    assert [r._dq_errors for r in rejected] == [["validity:unparsable_document"]] * 2
    assert len({r._source_payload_hash for r in rejected}) == 2


def test_trace_import(spark, path):
    from tests.test_adapters import journey

    _events(f"{path}/t.jsonl", journey(), "{", {"id": "no start"})
    counts = backfill.import_traces(spark, f"{path}/t.jsonl", f"{path}/t")
    assert counts == {"agent_run": 1, "agent_span": 2, "tool_call": 2, "retrieval": 1, "feedback": 1, "evaluation": 1, "rejects": 2}


def test_undated_trajectories_share_one_clock_reading(spark, path):
    from tests.test_adapters import trajectory

    _events(f"{path}/t.jsonl", trajectory(metadata={"session_id": "undated"}))
    backfill.import_trajectories(spark, f"{path}/t.jsonl", f"{path}/t")
    run, first = spark.read.parquet(f"{path}/t/runs").first(), spark.read.parquet(f"{path}/t/spans").orderBy("span_order").first()
    assert (first.start_time - run.start_time).total_seconds() < 1 and first.date == run.date


def test_loads_keep_each_others_undated_rejects(spark, path):
    schema = CONTRACTS["llm_request"].schema
    for i in (1, 2, 2):
        undated = facts.validated(rows(spark, "llm_request", request(i, date=None, latency_ms=0)), "llm_request")
        writers.write_validated(undated, path, load_id=f"load{i}")
    assert sorted(r.request_id for r in writers.read_rejected(spark, path, schema).collect()) == ["r1", "r2"]


def test_undated_rows_count_in_a_ranged_load(spark, path):
    source = f"{path}/in.jsonl"
    _events(source, _raw(1, "2026-01-05"), _raw(2, "2026-01-06") | {"date": None, "created_at": None})
    counts = backfill.backfill_requests(spark, source, f"{path}/wh", "2026-01-05", "2026-01-05")
    assert (counts["input_rows"], counts["fact_rows"], counts["quarantine_rows"]) == (2, 1, 1)


def test_only_published_tables_are_published(spark, path):
    import pytest

    with pytest.raises(ValueError, match="no published table"):
        writers.publish_files(rows(spark, "llm_request", request(1)), "requests", path)
    for name, first, last in (("weekly_summary", "week_start_date", "total_ai_cost_amt_1w"), ("trace_health", "date", "child_observation_summary"),
                              ("experiment_regression", "dataset_name", "candidate_estimated_cost_usd_denominator")):
        columns = writers.PUBLISHED_COLUMNS[name]
        assert (columns[0], columns[-1], len(set(columns))) == (first, last, len(columns))
        assert not {"prompt_text", "response_text", "arguments_json", "result_text"} & set(columns)


def test_message_parsing_skips_broken_rows(spark):
    messages = spark.createDataFrame([('{"request_id":"a","latency_ms":5}',), ("{broken",), ("{}",)], "value string")
    out = readers.parse_messages(messages, CONTRACTS["llm_request"])
    assert sorted(r.request_id or "" for r in out.collect()) == ["", "a"]
    assert facts.typed(out.where("request_id = 'a'"), "llm_request", fill_nulls=True).first().latency_ms == 5


def test_dateless_rows_of_one_input_are_stored_once(spark, path):
    """Two loads over different ranges of one input, then a load of another input."""
    days = [date(2026, 1, 5), date(2026, 1, 6), None]
    for name, first in (("a", 0), ("b", 10)):
        os.makedirs(f"{path}/{name}")
        with open(f"{path}/{name}/rows.json", "w") as out:
            for i, day in enumerate(days):
                row = {k: v for k, v in request(first + i).items()} | {
                    "date": day and str(day), "created_at": "2026-01-05T09:00:00+00:00", "app_name": "a", "feature_name": "f", "user_id": "u", "session_id": "s",
                    "provider": "p", "model_name": "m", "status": "success", "mode": "live",
                }
                out.write(json.dumps(row) + "\n")
    load = lambda name, day: backfill.load_fact(spark, readers.json_lines(spark, f"{path}/{name}", CONTRACTS["llm_request"]), "llm_request", f"{path}/facts", day, day)
    for day in ("2026-01-05", "2026-01-06"):
        stored, counts = load("a", day)
        assert counts["input_rows"] == 2
    both = lambda: sorted(r.request_id for r in spark.read.parquet(f"{path}/facts").collect())
    assert both() == ["r0", "r1", "r2"]
    load("b", "2026-01-05")
    assert both() == ["r1", "r10", "r12", "r2"]
