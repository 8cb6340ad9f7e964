"""Run the registered queries and their SQL side by side: python -m workload.check [sf_dir] [name ..]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return f"{type(v).__name__}:{v}"


def normal(columns: list[str], rows: list) -> tuple[list[str], list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_cell(r[i]) for i in order) for r in rows])


def compare(spark_result: tuple, sql_result: tuple) -> str | None:
    (a_cols, a), (b_cols, b) = spark_result, sql_result
    if a_cols != b_cols:
        return f"columns {a_cols} <> {b_cols}"
    if len(a) != len(b):
        return f"rows {len(a)} <> {len(b)}"
    for x, y in zip(a, b, strict=True):
        if x != y:
            return f"\n  spark {dict(zip(a_cols, x, strict=True))}\n  sql   {dict(zip(b_cols, y, strict=True))}"
    return None


def main() -> int:
    from garimpo.session import build_session, tune
    from workload import ALL

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    wanted = set(args[1:])
    spark, con = tune(build_session("check")), connect(sf_dir)
    bad = 0
    for q in ALL:
        if wanted and q.name not in wanted:
            continue
        start = time.time()
        try:
            df = q.run(spark, sf_dir)
            got = normal(df.columns, df.collect())
            spent = time.time() - start
            if q.sql is None:
                problem = None
            else:
                res = con.execute(q.sql)
                problem = compare(got, normal([d[0] for d in res.description], res.fetchall()))
        except Exception as e:  # noqa: BLE001
            spent, problem, got = time.time() - start, f"{type(e).__name__}: {str(e)[:1500]}", ([], [])
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {q.name:28} {len(got[1]):7} rows {spent:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
