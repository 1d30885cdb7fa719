"""Compare registered queries with their oracles, value by value.

usage: python -m workload.check [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from workload.document_queries import ORACLES, QUERIES
from workload.views import TABLES


def cell(value) -> str:
    if value is None:
        return "~"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if hasattr(value, "tzinfo"):
        return str(value.replace(tzinfo=None))
    return str(value)


def rows_of(table) -> list[tuple[str, ...]]:
    names = sorted(table.column_names)
    return sorted(tuple(cell(row[n]) for n in names) for row in table.to_pylist())


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = tuple(sys.argv[2:])
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    bad = 0
    for name, query in QUERIES.items():
        if wanted and not name.startswith(wanted):
            continue
        started = time.time()
        try:
            got_frame = query(spark, sf_dir)
            got = got_frame.toArrow()
            took = time.time() - started
            if name not in ORACLES:
                print(f"rows  {name} rows={got.num_rows} {took:.1f}s")
                continue
            expected_raw = db.execute(ORACLES[name])
            types = {d[0]: str(d[1]) for d in expected_raw.description}
            expected = expected_raw.to_arrow_table()
        except Exception as error:  # noqa: BLE001 - report and go on
            bad += 1
            print(f"ERROR {name}: {str(error)[:600]}")
            continue
        if sorted(got.column_names) != sorted(expected.column_names):
            bad += 1
            print(f"COLS  {name}: {sorted(set(got.column_names) ^ set(expected.column_names))}")
            continue
        wide = [c for c, t in types.items() if "HUGEINT" in t or "DECIMAL" in t]
        left, right = rows_of(got), rows_of(expected)
        if left != right or wide:
            bad += 1
            print(f"DIFF  {name}: rows {len(left)} vs {len(right)} wide={wide}")
            names = sorted(got.column_names)
            only_left, only_right = sorted(set(left) - set(right)), sorted(set(right) - set(left))
            print("   differing rows", len(only_left), len(only_right))
            for a, b in list(zip(only_left, only_right))[:2]:
                print("   ", [(n, x, y) for n, x, y in zip(names, a, b) if x != y])
        else:
            print(f"ok    {name} rows={len(left)} {took:.1f}s")
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
