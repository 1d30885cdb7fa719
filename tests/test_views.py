import glob
import re

from pyspark.sql import functions as F

from workload import document_queries, views
from workload.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_lines_are_joined_last(spark):
    """Else all lines are shuffled a second time, by customer."""
    for name, sql in views.VIEWS.items():
        if views._LINES not in sql:
            continue
        got = views.view(spark, SMALL, name)
        top = next(line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line)
        assert "l_orderkey" in top and "c_custkey" not in top
        if name == "llm_request":
            plain = spark.sql(sql)
            assert got.columns == plain.columns
            assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty() and got.count() > 5000


def test_raw_requests_of_the_backfill_are_compressed(spark, tmp_path, monkeypatch):
    def stop(spark, raw, warehouse):
        assert glob.glob(f"{raw}/*.json.gz") and not glob.glob(f"{raw}/*.json")
        return spark.read.json(raw).count()

    rows = []
    monkeypatch.setattr(document_queries, "scratch", lambda spark: str(tmp_path))
    monkeypatch.setattr(document_queries.backfill, "backfill_requests", lambda *a: rows.append(stop(*a)))
    views.view(spark, SMALL, "llm_request").write.parquet(f"{tmp_path}/warehouse/feature_daily")
    document_queries._backfilled(spark, SMALL)
    assert rows == [views.view(spark, SMALL, "llm_request").count()]


def _dealt(frame):
    """Keys of the shuffles of a query that was run, without those that were read again."""
    final = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    own = [line for line in final.splitlines() if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    return [tuple(re.findall(r"(\w+)#", line.split("hashpartitioning(")[1].split("), ")[0])) for line in own]


def test_facts_of_traces_share_their_shuffles(spark):
    """Lines and orders are shuffled once for all five facts, and no partial rows of traces."""
    for name in ("llm_request", "agent_run", "retrieval"):
        got, plain = views.shared(spark, SMALL, name, by_trace=True), views.view(spark, SMALL, name)
        assert got.columns == plain.columns
        assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty() and got.count() > 1000
    mart = QUERIES["mart_trace_health"](spark, SMALL)
    assert len(mart.collect()) > 1000
    assert sorted(_dealt(mart)) == [("l_key",), ("o_key",)]


def test_facts_of_many_lines_are_grouped_in_many_tasks(spark, monkeypatch):
    few = QUERIES["mart_trace_health"](spark, SMALL)
    monkeypatch.setattr(views, "TASK_LINES", 500)
    many = QUERIES["mart_trace_health"](spark, SMALL)
    n = views.table(spark, SMALL, "lineitem").count() // 500
    assert n > 4 and many.exceptAll(few).isEmpty() and many.count() == few.count() > 1000
    many.collect()
    dealt = [line for line in many._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert dealt and all(f", {n}), REPARTITION_BY_NUM" in line for line in dealt)


def test_all_summaries_of_the_verification_read_the_same_lines(spark):
    totals = QUERIES["verify_summary_totals"](spark, SMALL)
    assert len(totals.collect()) == 14
    keys = _dealt(totals)
    assert keys.count(("l_key",)) == keys.count(("o_key",)) == 1 and not [k for k in keys if "orderkey" in k[0]]
    assert len(keys) > 14 and not {"_value", "_bin", "_place"} & {c for k in keys for c in k}  # no percentile or distinct count that no total needs


def test_shared_facts_keep_orders_without_a_key(spark, path):
    for name in ("lineitem", "orders", "customer"):
        rows = spark.read.parquet(f"{SMALL}/{name}.parquet")
        for key in ("l_orderkey", "o_orderkey"):
            if key in rows.columns:
                rows = rows.withColumn(key, F.expr(f"nullif({key}, (select min({key}) from parquet.`{SMALL}/{name}.parquet`)) - 2"))
        rows.write.parquet(f"{path}/{name}.parquet")
    for name in ("llm_request", "agent_run", "feedback", "handoff"):
        got, plain = views.shared(spark, path, name), views.view(spark, path, name)
        assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty() and got.count() == plain.count() > 1000
    assert views.shared(spark, path, "agent_run").where("run_id is null").count() == 1
