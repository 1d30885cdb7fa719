import json
import os
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from lampyris.contracts import CONTRACTS
from lampyris.plans import facts, summaries
from lampyris.sources import readers
from lampyris.streaming import jobs
from tests.builders import request

CONTRACT = CONTRACTS["llm_request"]


def _events(first, count, **kw):
    out = []
    for i in range(first, first + count):
        at = datetime(2026, 1, 5 + i % 2, 9 + i % 3, i % 60)
        out.append(
            request(i, created_at=at.isoformat() + "+00:00", date=str(at.date()), app_name="a", feature_name=f"f{i % 2}",
                    model_name="m", status="error" if i % 7 == 0 else "success", mode="live", user_id=f"u{i % 5}",
                    session_id=f"s{i % 4}", latency_ms=i * 37 % 900 + 1) | kw
        )
    return out


def _drop(path, name, events):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.jsonl", "w") as out:
        out.writelines(json.dumps(e) + "\n" for e in events)


def _messages(spark, path):
    return readers.parse_messages(readers.file_stream(spark, path, max_files=1), CONTRACT)


def _batch(spark, path):
    parsed = readers.parse_messages(spark.read.text(path), CONTRACT)
    return facts.valid(parsed, "llm_request", fill_nulls=True, null_fails=True)


def _run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_restart_loses_and_repeats_nothing(spark, path):
    source, store, check = f"{path}/in", f"{path}/facts", f"{path}/check"
    _drop(source, "a", _events(0, 100))
    _run(jobs.start_fact(_messages(spark, source), "llm_request", store, check))
    _drop(source, "b", _events(100, 50))
    _run(jobs.start_fact(_messages(spark, source), "llm_request", store, check))
    stored = jobs.stored_fact(spark, "llm_request", store)
    assert stored.count() == 150 and stored.select("request_id").distinct().count() == 150


def test_repeated_batch_replaces_itself(spark, path):
    frame = spark.createDataFrame([(date(2026, 1, 5), 1), (date(2026, 1, 6), 2)], "date date, v int")
    for _ in range(2):
        jobs.append_batch(frame, 7, path)
    jobs.append_batch(frame, 8, path)
    assert jobs.read_appended(spark, path).count() == 4


def test_rejects_are_kept_beside_valid_rows(spark, path):
    source = f"{path}/in"
    _drop(source, "a", [*_events(0, 5), *_events(5, 2, latency_ms=None)])
    _run(jobs.start_fact(_messages(spark, source), "llm_request", f"{path}/facts", f"{path}/check"))
    assert jobs.stored_fact(spark, "llm_request", f"{path}/facts").count() == 5
    rejected = spark.read.parquet(f"{path}/facts").where("_dq_status = 'quarantine'")
    assert {tuple(r._dq_errors) for r in rejected.collect()} == {("validity:non_positive_latency",)}


def test_closed_hours_equal_the_batch_summary(spark, path):
    source = f"{path}/in"
    start = datetime(2026, 1, 5, 9)
    events = []
    for i in range(240):
        at = start + timedelta(minutes=i)
        events += _events(i, 1, created_at=at.isoformat() + "+00:00", date=str(at.date()))
    for part in range(4):
        _drop(source, f"p{part}", events[part * 60 : (part + 1) * 60])
    # A later event closes the last hour; it stays open itself.
    _drop(source, "z", _events(999, 1, created_at="2026-01-05T15:00:00+00:00", date="2026-01-05"))
    stream = facts.valid(_messages(spark, source), "llm_request", fill_nulls=True, null_fails=True)
    _run(jobs.start_hourly(stream, f"{path}/hourly", f"{path}/check"))
    got = jobs.read_appended(spark, f"{path}/hourly").drop("_batch")
    want = summaries.feature_hourly(_batch(spark, source)).where("hour < 15")
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())
    daily = jobs.daily_from_hourly(spark, f"{path}/hourly")
    assert daily.agg(F.sum("request_count")).first()[0] == 240


def test_late_rows_are_dropped_behind_the_watermark(spark, path):
    source = f"{path}/in"
    at = lambda text: dict(created_at=f"2026-01-05T{text}+00:00", date="2026-01-05")
    # One file per batch, taken in the order of modification.  Spark judges
    # lateness by the watermark the batch before started with, so "b2" lets it advance.
    order = (("a", "09:10:00"), ("b", "11:00:00"), ("b2", "11:05:00"), ("c", "09:20:00"), ("d", "13:00:00"))
    for place, (name, event) in enumerate((n, at(t)) for n, t in order):
        _drop(source, name, _events(1, 1, **event))
        os.utime(f"{source}/{name}.jsonl", (1_700_000_000 + place, 1_700_000_000 + place))
    stream = facts.valid(_messages(spark, source), "llm_request", fill_nulls=True, null_fails=True)
    _run(jobs.start_hourly(stream, f"{path}/hourly", f"{path}/check"))
    got = jobs.read_appended(spark, f"{path}/hourly")
    assert sorted((r.hour, r.request_cnt_1h) for r in got.collect()) == [(9, 1), (11, 2)]


def test_updating_summary_equals_batch(spark, path):
    source = f"{path}/in"
    for part in range(3):
        _drop(source, f"p{part}", _events(part * 40, 40))
    stream = facts.valid(_messages(spark, source), "llm_request", fill_nulls=True, null_fails=True)
    _run(jobs.start_rollup(stream, summaries.FEATURE_DAILY, f"{path}/parts", f"{path}/daily", f"{path}/check"))
    want = summaries.feature_daily(_batch(spark, source))
    got = spark.read.parquet(f"{path}/daily").select(want.columns)
    assert sorted(got.collect()) == sorted(want.collect())


def test_joined_summary_is_rebuilt_for_touched_dates(spark, path):
    source = f"{path}/in"
    for part in range(2):
        _drop(source, f"p{part}", _events(part * 40, 40))
    feedback = spark.createDataFrame(
        [(date(2026, 1, 5), "a", "f0", "s0", "thumbs_up", None)],
        "date date, app_name string, feature_name string, session_id string, feedback_type string, rating_value int",
    )
    build = lambda requests, dates: summaries.session_daily(requests, feedback.where(F.col("date").isin(dates)))
    stream = facts.valid(_messages(spark, source), "llm_request", fill_nulls=True, null_fails=True)
    _run(jobs.start_recompute(stream, f"{path}/facts", "llm_request", build, f"{path}/sessions", f"{path}/check"))
    want = summaries.session_daily(_batch(spark, source), feedback)
    assert sorted(spark.read.parquet(f"{path}/sessions").select(want.columns).collect()) == sorted(want.collect())


def test_upsert_keeps_the_last_write(spark, path):
    source = f"{path}/in"
    _drop(source, "a", _events(0, 10))
    _run(jobs.start_upsert(facts.typed(_messages(spark, source), "llm_request", True), f"{path}/t", f"{path}/check"))
    _drop(source, "b", _events(5, 10, latency_ms=77))
    _run(jobs.start_upsert(facts.typed(_messages(spark, source), "llm_request", True), f"{path}/t", f"{path}/check"))
    current = jobs.current_rows(spark, f"{path}/t", ["request_id"])
    assert current.count() == 15 and current.where("latency_ms = 77").count() == 10
    jobs.compact(spark, f"{path}/t", f"{path}/compacted", ["request_id"])
    assert spark.read.parquet(f"{path}/compacted").count() == 15


def test_pass_through_copy(spark, path):
    source = f"{path}/in"
    _drop(source, "a", _events(0, 3))
    _run(jobs.start_file_copy(_messages(spark, source), f"{path}/out", f"{path}/check"))
    copied = readers.parse_messages(spark.read.text(f"{path}/out"), CONTRACT)
    assert copied.count() == 3


def test_rows_without_a_date_are_summarised_too(spark, path):
    source = f"{path}/in"
    for part in range(2):
        _drop(source, f"p{part}", [*_events(part * 10, 10), *_events(100 + part, 1, date=None)])
    stream = facts.typed(_messages(spark, source), "llm_request", True)
    _run(jobs.start_rollup(stream, summaries.FEATURE_DAILY, f"{path}/parts", f"{path}/daily", f"{path}/check"))
    got = spark.read.parquet(f"{path}/daily")
    assert got.agg(F.sum("request_count")).first()[0] == 22
    assert got.where("date is null").agg(F.sum("request_count")).first()[0] == 2


def test_compaction_leaves_no_copy_under_an_old_date(spark, path):
    rows = lambda day, v: spark.createDataFrame([("k1", date(2026, 1, day), v), ("k2", date(2026, 1, 7), 0)], "k string, date date, v int")
    for batch, day in ((1, 5), (2, 6)):
        jobs.append_batch(rows(day, batch), batch, f"{path}/changes")
        jobs.compact(spark, f"{path}/changes", f"{path}/now", ["k"])
    assert sorted((r.k, r.date.day, r.v) for r in spark.read.parquet(f"{path}/now").collect()) == [("k1", 6, 2), ("k2", 7, 0)]
