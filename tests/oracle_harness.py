"""Compare each registered query with its DuckDB oracle, the way the driver does:
same column names, same row count, same multiset of rows (order-insensitive).

Run standalone:  python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def constant_columns(columns, records):
    """Columns with a single value (NULL included) in a result of several rows: a check of them
    shows little."""
    if len(records) < 2:
        return []
    return [c for i, c in enumerate(columns) if len({str(norm(r[i])) for r in records}) == 1]


def compare(spark, con, name, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = rows_of(s_cols, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    o_cols = rel.columns
    o_rows = rows_of(o_cols, rel.fetchall())
    problems = []
    if sorted(s_cols) != sorted(o_cols):
        problems.append(f"columns spark={sorted(s_cols)} oracle={sorted(o_cols)}")
    if len(s_rows) != len(o_rows):
        problems.append(f"rows spark={len(s_rows)} oracle={len(o_rows)}")
    elif s_rows != o_rows:
        diff = [(a, b) for a, b in zip(s_rows, o_rows) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return len(s_rows), problems


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from docmart.session import get_session

    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, os_ = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        if name not in os_:
            n = fn(spark, sf_dir).count()
            print(f"{name:28s} rows={n:<8d} (no oracle) {time.time() - t0:.1f}s")
            continue
        try:
            n, problems = compare(spark, con, name, fn, os_[name], sf_dir)
        except Exception as e:  # report and go on
            n, problems = -1, [f"error: {str(e)[:400]}"]
        bad += bool(problems)
        status = "OK " if not problems else "BAD"
        print(f"{status} {name:28s} rows={n:<8d} {time.time() - t0:.1f}s {'; '.join(problems)[:1500]}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
