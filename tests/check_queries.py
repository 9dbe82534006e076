"""Run registered queries beside their SQL: python tests/check_queries.py [sf] [names]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def main() -> int:
    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{scale}"
    names = sys.argv[2:] or list(registry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    failed = 0
    for name in names:
        started = time.time()
        try:
            frame = registry.queries()[name](spark, folder)
            got = frame.toArrow()
            took = time.time() - started
            verdict = compare(got, db, registry.oracle_sql().get(name))
        except Exception as error:
            took, verdict = time.time() - started, f"ERROR {str(error)[:1500]}"
        failed += not verdict.startswith(("ok", "rows only"))
        print(f"{name:24s} {took:6.1f}s  {verdict}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return failed


def compare(got, db, sql) -> str:
    if sql is None:
        return f"rows only: {got.num_rows}"
    started = time.time()
    want = db.execute(sql).to_arrow_table()
    columns = sorted(got.column_names)
    if columns != sorted(want.column_names):
        return f"COLUMNS {columns} {sorted(want.column_names)}"
    types = [
        (c, str(got.schema.field(c).type), str(want.schema.field(c).type))
        for c in columns
        if str(got.schema.field(c).type) != str(want.schema.field(c).type)
    ]
    a = sorted(map(repr, zip(*[got[c].to_pylist() for c in columns])))
    b = sorted(map(repr, zip(*[want[c].to_pylist() for c in columns])))
    if a != b:
        only = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return f"VALUES {len(a)} {len(b)}\n  spark {str(only[0])[:600]}\n  duck  {str(only[1])[:600]}"
    return f"ok {len(a)} rows {types or ''} (sql {time.time() - started:.1f}s)"


if __name__ == "__main__":
    sys.exit(main())
