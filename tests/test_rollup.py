import math
import random
from collections import defaultdict

from lampyris.operators.rollup import DistinctCount, Percentile, Rollup, mean, mean_exact, peak, rows, rows_where, total


def _data(spark, n=4000):
    rng = random.Random(7)
    # One group holds half of all rows.
    data = [
        ("hot" if rng.random() < 0.5 else f"g{rng.randrange(40)}", rng.randrange(500) if rng.random() < 0.97 else None,
         rng.randrange(1000) / 1000, f"u{rng.randrange(50)}")
        for _ in range(n)
    ]
    return data, spark.createDataFrame(data, "k string, v int, x double, u string").repartition(7)


def _rank(values, percent):
    values = sorted(v for v in values if v is not None)
    return values[max(math.ceil(percent * len(values) / 100 - 1e-12), 1) - 1] if values else None


def test_percentile_equals_brute_force(spark):
    data, frame = _data(spark)
    rollup = Rollup(("k",), (rows("n"), total("s", "v"), mean("a", "v", 2), peak("m", "v")), Percentile("p", "v", 95))
    got = {r.k: r for r in rollup.build(frame).collect()}
    groups = defaultdict(list)
    for k, v, _, _ in data:
        groups[k].append(v)
    assert set(got) == set(groups)
    for k, values in groups.items():
        known = [v for v in values if v is not None]
        assert (got[k].n, got[k].s, got[k].m, got[k].p) == (len(values), sum(known), max(known), _rank(values, 95))


def test_binned_percentile_equals_plain(spark):
    data, frame = _data(spark)
    measures = (rows("n"), mean_exact("a", "x", 4), peak("m", "x"))
    plain = Rollup(("k",), measures, Percentile("p", "x", 10)).build(frame).collect()
    binned = Rollup(("k",), measures, Percentile("p", "x", 10, bin_width=0.01)).build(frame).collect()
    assert sorted(plain) == sorted(binned)
    groups = defaultdict(list)
    for k, _, x, _ in data:
        groups[k].append(x)
    assert {r.k: r.p for r in binned} == {k: _rank(v, 10) for k, v in groups.items()}


def test_binned_percentile_of_edges_nulls_and_repeated_keys(spark):
    """Values on bin edges, negative, infinite and NaN ones, groups of one bin, null values among others and partials of batches."""
    rng = random.Random(3)
    special = [-0.5, -0.01, 0.0, 0.01, 0.02, float("inf"), float("-inf"), float("nan"), None]
    data = [(rng.choice([None, "a", "b"]), rng.choice([1, None]), rng.choice(special) if rng.random() < 0.7 else rng.uniform(-0.02, 0.02)) for _ in range(600)]
    data += [("one", 1, 0.25)] * 5 + [("none", None, None)] * 3
    frame = spark.createDataFrame(data, "k string, j int, x double").repartition(5)
    order = lambda v: (v != v, v)
    for percent in (1, 10, 50, 99):
        rollup = Rollup(("k", "j"), (rows("n"), total("s", "j")), Percentile("p", "x", percent, bin_width=0.01))
        groups = defaultdict(list)
        for k, j, x in data:
            groups[k, j].append(x)
        expected = {}
        for key, values in groups.items():
            known = sorted((v for v in values if v is not None), key=order)
            hit = known[max(-(-percent * len(known) // 100), 1) - 1] if known else None
            expected[key] = (len(values), len(values) if key[1] else None, str(hit))
        halves = rollup.partials(frame.where("x < 0.01")).unionByName(rollup.partials(frame.where("x >= 0.01 or x is null")))
        for out in (rollup.build(frame), rollup.finish(halves)):
            assert {(r.k, r.j): (r.n, r.s, str(r.p).replace("-0.0", "0.0") if r.p == 0 else str(r.p)) for r in out.collect()} == expected


def test_null_keys_and_all_null_values_are_kept(spark):
    frame = spark.createDataFrame([(None, None, 0.5), (None, 3, 0.1), ("a", None, None)], "k string, v int, x double")
    out = Rollup(("k",), (rows("n"),), Percentile("p", "v", 95)).build(frame)
    assert {(r.k, r.n, r.p) for r in out.collect()} == {(None, 2, 3), ("a", 1, None)}
    out = Rollup(("k",), (rows("n"),), Percentile("p", "x", 10, bin_width=0.01)).build(frame)
    assert {(r.k, r.n, r.p) for r in out.collect()} == {(None, 2, 0.1), ("a", 1, None)}


def test_distinct_count_and_partials_of_several_batches(spark):
    data, frame = _data(spark)
    rollup = Rollup(("k",), (rows("n"), rows_where("big", "v > 250")), distinct=DistinctCount("users", "u"))
    whole = rollup.build(frame)
    halves = rollup.partials(frame.where("x < 0.5")).unionByName(rollup.partials(frame.where("x >= 0.5")))
    assert sorted(whole.collect()) == sorted(rollup.finish(halves).collect())
    users = defaultdict(set)
    for k, _, _, u in data:
        users[k].add(u)
    assert {r.k: r.users for r in whole.collect()} == {k: len(v) for k, v in users.items()}


def test_totals_have_the_rows_and_sums_of_the_summary(spark):
    rng = random.Random(8)
    facts = spark.createDataFrame([(rng.choice("abc"), rng.choice([None, 1, 2]), rng.choice([None, 0.25, 0.5])) for _ in range(300)], "k string, j int, v double")
    for part in ({"percentile": Percentile("p", "v", 10, bin_width=0.01)}, {"distinct": DistinctCount("p", "v")}):
        rollup = Rollup(("k", "j"), (rows("n"), total("s", "j")), **part)
        assert rollup.totals(facts).columns == ["k", "j", "n", "s"]
        assert sorted(map(str, rollup.totals(facts).collect())) == sorted(map(str, rollup.build(facts).drop("p").collect()))
