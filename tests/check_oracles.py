"""Run registered queries and their SQL side by side: python tests/check_oracles.py [sf] [name ...]."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


# Python in the plan, all pairs, or whole rows in one task have no place at scale.
UNWANTED = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct",
            "BroadcastNestedLoopJoin")


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(table) -> tuple[list, list]:
    names = sorted(table.column_names)
    kinds = [str(table.schema.field(n).type).replace("large_string", "string") for n in names]
    columns = [table.column(n).to_pylist() for n in names]
    rows = [tuple(normal(v) for v in r) for r in zip(*columns)] if columns else []
    return list(zip(names, kinds)), sorted(rows, key=repr)


def compare(spark, con, name: str, query, folder: str) -> str:
    df = query.run(spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    bad = [x for x in UNWANTED if x in plan]
    if bad:
        return f"PLAN has {bad}"
    got_schema, got = rows_of(df.toArrow())
    if query.sql is None:
        return f"rows only: {len(got)}"
    want_schema, want = rows_of(con.sql(query.sql).to_arrow_table())
    if got_schema != want_schema:
        return f"SCHEMA {got_schema} <> {want_schema}"
    if len(got) != len(want):
        return f"ROWS {len(got)} <> {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"VALUE {a} <> {b}"
    return f"ok: {len(got)}"


if __name__ == "__main__":
    from conftest import make_session
    from prepkit.registry import all_queries

    sf, names = (sys.argv[1:2] or ["0.01"])[0], sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark, con = make_session(), duck(folder)
    bad = 0
    for name, query in all_queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            verdict = compare(spark, con, name, query, folder)
        except Exception as error:  # noqa: BLE001 - report and go on
            verdict = f"ERROR {type(error).__name__}: {str(error)[:400]}"
        good = verdict.startswith(("ok", "rows only"))
        bad += not good
        print(f"{'  ' if good else '!!'} {name:28s} {time.time() - start:6.2f}s  {verdict[:600]}", flush=True)
    print(f"{bad} differ")
    sys.exit(bad > 0)
