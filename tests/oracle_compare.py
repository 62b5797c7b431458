"""Run registered queries against their DuckDB oracles and compare the results.

Usage: python -m tests.oracle_compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.12g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(records) -> list[tuple]:
    out = [tuple(_norm(x) for x in r) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def oracle(sf_dir: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    rel = con.sql(sql)
    cols = rel.columns
    return cols, rel.fetchall()


def compare(spark, sf_dir: str, name: str, query, sql: str) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    o_cols, o_rows = oracle(sf_dir, sql)
    s_order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    o_order = sorted(range(len(o_cols)), key=lambda i: o_cols[i])
    if sorted(s_cols) != sorted(o_cols):
        return False, f"columns differ: spark={sorted(s_cols)} oracle={sorted(o_cols)}"
    a = rows_of([tuple(r[i] for i in s_order) for r in s_rows])
    b = rows_of([tuple(r[i] for i in o_order) for r in o_rows])
    if len(a) != len(b):
        return False, f"row count spark={len(a)} oracle={len(b)}"
    if a != b:
        diff = next(i for i in range(len(a)) if a[i] != b[i])
        return False, f"values differ at {diff}: spark={a[diff]} oracle={b[diff]}"
    return True, f"{len(a)} rows"


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from sluice.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = local_session(8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, q in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            ok, msg = compare(spark, sf_dir, name, q, sqls[name]) if name in sqls else (True, "no oracle")
        except Exception as exc:  # report and go on with the next query
            ok, msg = False, f"error: {str(exc)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:24s} {time.time() - t:6.1f}s {msg}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
