from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lampyris.operators import rollup as R
from lampyris.plans import summaries
from lampyris.sources import writers
from lampyris.streaming.segments import NO_DAY, Segments
from lampyris.streaming.upserts import UpsertTable
from tests.builders import request, rows

_DAILY = R.Rollup(("date", "k"), (R.rows("n"), R.total("s", "v"), R.peak("m", "v")), R.Percentile("p", "v", 95))


def _facts(spark, *given):
    return spark.createDataFrame(list(given), "date date, k string, v int")


def _sum(frame):
    return frame.groupBy("date", "k").agg(F.sum("v").alias("v"))


def test_states_merge_to_the_discrete_percentile(spark):
    day = date(2026, 1, 5)
    given = [(day if i % 11 else None, f"k{i % 3}", None if i % 13 == 0 else i * 37 % 90) for i in range(300)] + [(day, "empty", None)]
    facts = _facts(spark, *given)
    want = sorted(map(str, _DAILY.build(facts).collect()))
    parts = [_facts(spark, *given[i::4]) for i in range(4)]
    states = [_DAILY.state(p) for p in parts]
    assert all(s.count() == s.select("date", "k").distinct().count() for s in states)
    pairs = [_DAILY.merge(a.unionByName(b)) for a, b in (states[:2], states[2:])]
    merged = _DAILY.merge(pairs[0].unionByName(pairs[1]))
    assert merged.count() == len(want)
    for got in (merged, pairs[0].unionByName(pairs[1])):
        assert sorted(map(str, _DAILY.result(got).collect())) == want


@pytest.mark.parametrize("name", ["FEEDBACK_DAILY", "EVALUATION_DAILY", "TOOL_DAILY", "RETRIEVAL_DAILY", "REGION_DAILY", "FEATURE_DAILY"])
def test_every_kind_of_rollup_has_states(spark, name):
    rollup = getattr(summaries, name)
    fact = {"FEEDBACK_DAILY": "feedback", "EVALUATION_DAILY": "evaluation", "TOOL_DAILY": "tool_call", "RETRIEVAL_DAILY": "retrieval"}.get(name, "llm_request")
    values = lambda i: {
        "feedback": {"feedback_id": f"f{i}", "request_id": f"r{i % 3}", "feedback_type": "rating", "rating_value": i % 5 + 1},
        "evaluation": {"evaluation_id": f"e{i}", "score": i % 7 / 7, "passed": i % 2 == 0, "evaluation_latency_ms": i},
        "tool_call": {"tool_call_id": f"t{i}", "duration_ms": i % 6 + 1, "result_size": i},
        "retrieval": {"retrieval_id": f"v{i}", "total_latency_ms": i % 5 + 1, "returned_count": i % 2, "avg_similarity_score": i / 40},
    }.get(fact, request(i, latency_ms=i % 9 + 1))
    facts = rows(spark, fact, *map(values, range(40)))
    halves = [rollup.state(rows(spark, fact, *map(values, range(i, 40, 2)))) for i in range(2)]
    merged = rollup.merge(halves[0].unionByName(halves[1]))
    assert sorted(map(str, rollup.result(merged).collect())) == sorted(map(str, rollup.build(facts).collect()))


def test_many_batches_leave_few_segments(spark, path, monkeypatch):
    """200 batches on one day by the lists alone: few live folders, which cover every batch once."""
    kept = {}
    monkeypatch.setattr(Segments, "_write", lambda self, rows, name: {"d": name})
    monkeypatch.setattr(Segments, "live", lambda self, day: kept.get(day, []))
    monkeypatch.setattr(Segments, "_commit", lambda self, day, segments, schema: kept.update({day: list(segments)}))
    merged = []
    monkeypatch.setattr(Segments, "_read", lambda self, folders, schema: merged.append(len(folders)) or rows)
    store, rows = Segments(spark, path), _facts(spark, (date(2026, 1, 5), "k", 1))
    for batch in range(200):
        store.add(batch, rows, lambda r: r)
        spans = sorted((s["first"], s["last"]) for s in kept["d"])
        assert len(spans) <= 11 and spans[0][0] == 0 and spans[-1] == (batch, batch)
        assert all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))
    assert sum(merged) < 200 * 6


def test_a_merge_keeps_every_row_and_removes_old_folders(spark, path):
    store, day = Segments(spark, path), date(2026, 1, 5)
    for batch in range(9):
        assert store.add(batch, _facts(spark, (day, f"k{batch % 3}", batch)), _sum) == ["2026-01-05"]
    live = store.read(["2026-01-05"])
    assert live.agg(F.sum("v")).first()[0] == sum(range(9)) and max(s["level"] for s in store.live("2026-01-05")) >= 1
    versions = [n for n in store._manifest("2026-01-05").names(f"{path}/days/2026-01-05") if n.endswith(".json")]
    assert len(versions) == 3 and store._manifest("2026-01-05").names(f"{path}/data")


@pytest.mark.parametrize("stage", ["segment", "first day", "merge", "swap"])
def test_a_batch_repeated_after_a_failure_counts_once(spark, path, monkeypatch, stage):
    """The writer dies after the given step of a batch that also merges; the batch is then run again."""
    store, days = Segments(spark, path), (date(2026, 1, 5), date(2026, 1, 6), None)
    batch_rows = lambda b: _facts(spark, *[(d, "k", b + 1) for d in days])
    for batch in range(3):
        store.add(batch, batch_rows(batch), _sum)

    class Died(Exception):
        pass

    seen = []
    write, commit = Segments._write, Segments._commit

    def failing_write(self, rows, name):
        out = write(self, rows, name)
        seen.append(name)
        if (stage == "segment") or (stage == "merge" and name.startswith("merged")):
            raise Died
        return out

    def failing_commit(self, day, segments, schema):
        commit(self, day, segments, schema)
        seen.append(day)
        if stage == "first day" or (stage == "swap" and any(s["level"] for s in segments)):
            raise Died

    with monkeypatch.context() as patched:
        patched.setattr(Segments, "_write", failing_write)
        patched.setattr(Segments, "_commit", failing_commit)
        with pytest.raises(Died):
            store.add(3, batch_rows(3), _sum)
    for _ in range(2):
        store.add(3, batch_rows(3), _sum)
    got = {r.date: r.v for r in _sum(store.read()).collect()}
    assert got == {d: 1 + 2 + 3 + 4 for d in days} and store.days() == ["2026-01-05", "2026-01-06", NO_DAY]


def _changes(spark, low, high, version, step=1):
    return spark.createDataFrame([(f"k{i}", version, date(2026, 1, 1 + version), i) for i in range(low, high, step)], "k string, version long, date date, v int")


def test_compaction_rewrites_touched_buckets_only(spark, path):
    table = UpsertTable(spark, path, ["k"], ["version"], buckets=16)
    assert table.current() is None and table.compact() == []
    table.add(0, _changes(spark, 0, 400, 1))
    assert sorted(table.compact(), key=int) == [str(b) for b in range(16)]
    before = table.manifest.latest()
    reader = table.current()  # keeps the version it began with
    table.add(1, _changes(spark, 0, 4, 2))
    delta = table.manifest.latest()["deltas"][0]["folders"]
    assert 0 < len(delta) <= 4
    assert sorted(table.compact()) == sorted(delta)
    after = table.manifest.latest()["base"]
    assert {b for b in after if after[b] != before["base"][b]} == set(delta)
    assert reader.where("version = 1").count() == 400
    now = table.current()
    assert now.count() == 400 and now.where("version = 2").count() == 4 and now.select("k").distinct().count() == 400


def test_upserts_keep_the_greatest_version_across_compactions(spark, path):
    table = UpsertTable(spark, path, ["k"], ["version"], buckets=4)
    table.add(0, _changes(spark, 0, 20, 5))
    table.compact()
    table.add(1, _changes(spark, 0, 20, 3, 2))  # older than what is there
    table.add(2, _changes(spark, 10, 30, 7))
    table.add(2, _changes(spark, 15, 30, 7))  # repeated with fewer rows: the first attempt is gone
    want = {f"k{i}": 7 if i >= 15 else 5 for i in range(30)}
    assert {r.k: r.version for r in table.current().collect()} == want
    table.compact()
    assert {r.k: r.version for r in UpsertTable(spark, path, ["k"], ["version"]).current().collect()} == want
    table.add(3, _changes(spark, 0, 1, 7))  # equal version: the later batch wins
    assert table.current().where("k = 'k0'").first()["_batch"] == 3
