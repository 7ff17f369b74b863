"""Run registered queries beside their check SQL: python tools/check.py FOLDER [NAME ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, (int, float)) or isinstance(b, float) and isinstance(a, int):
        return a == b or (math.isnan(a) and math.isnan(b)) or abs(a - b) <= 2e-6 * max(1.0, abs(a))
    return a == b


def order(row):
    return tuple((v is None, f"{v:.4f}" if isinstance(v, float) else str(v)) for v in row)


def compare(left, right) -> str:
    """Empty when both (columns, rows) agree as multisets; exact first, tolerant of the last digit second."""
    (lc, lr), (rc, rr) = left, right
    if sorted(lc) != sorted(rc):
        return f"columns {sorted(lc)} / {sorted(rc)}"
    if len(lr) != len(rr):
        return f"rows {len(lr)} / {len(rr)}"
    cols = sorted(lc)
    li, ri = [lc.index(c) for c in cols], [rc.index(c) for c in cols]
    a = sorted((tuple(r[i] for i in li) for r in lr), key=order)
    b = sorted((tuple(r[i] for i in ri) for r in rr), key=order)
    exact = sum(x != y for x, y in zip(a, b))
    bad = [(x, y) for x, y in zip(a, b) if not all(same(p, q) for p, q in zip(x, y))]
    if bad:
        return f"{len(bad)} rows differ, first {dict(zip(cols, bad[0][0]))} / {dict(zip(cols, bad[0][1]))}"
    return f"~{exact} rows differ in the last digit" if exact else ""


def run(spark, con, folder: str, name: str, query, sql: str | None) -> tuple[str, float, float, int]:
    start = time.time()
    df = query(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    took, mid = time.time() - start, time.time()
    if sql is None:
        return "rows only", took, 0.0, len(rows)
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    kinds = [str(c[1]) for c in cur.description]
    expected = cur.fetchall()
    note = compare((df.columns, rows), (names, expected)) or "ok"
    odd = [f"{n}:{k}" for n, k in zip(names, kinds) if "HUGEINT" in k or "DECIMAL" in k or k == "INTEGER" or k == "FLOAT"]
    return note + (f"  types {odd}" if odd else ""), took, time.time() - mid, len(rows)


if __name__ == "__main__":
    from setstride.plans import ORACLES, QUERIES
    from setstride.session import local_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session("check", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connection(folder)
    for name in wanted or QUERIES:
        try:
            note, took, sql_took, n = run(spark, con, folder, name, QUERIES[name], ORACLES.get(name))
        except Exception as e:  # report and go on with the next query
            note, took, sql_took, n = f"FAILED {type(e).__name__} {str(e)[:700]}", 0.0, 0.0, 0
        print(f"{name:28s} {n:8d} rows {took:6.1f}s sql {sql_took:5.1f}s  {note}", flush=True)
