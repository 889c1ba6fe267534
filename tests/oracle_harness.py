"""Run a registered Spark query and its DuckDB oracle and compare results.

Mirrors the driver's check: same column names, same row count and the same
multiset of rows (order-insensitive, columns sorted by name).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6f}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


def canon_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    out = {"query": name, "spark_rows": len(s_rows), "columns": s_cols}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out["oracle_rows"] = len(d_rows)
    a, ac = canon_rows(s_cols, s_rows)
    b, bc = canon_rows(d_cols, d_rows)
    if ac != bc:
        out["status"] = f"column mismatch spark={ac} oracle={bc}"
    elif len(a) != len(b):
        out["status"] = "row-count mismatch"
    elif a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["status"] = f"value mismatch e.g. {diff}"
    else:
        out["status"] = "ok"
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from wagegrid.config import session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = session(master="local[8]", shuffle_partitions=8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        try:
            r = compare(spark, name, qs[name], sqls.get(name), sf_dir, con)
        except Exception as e:  # report and continue
            r = {"query": name, "status": f"error {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r["status"], name, r.get("spark_rows"), r.get("oracle_rows"), flush=True)
    print(f"{bad} failing of {len(names or qs)}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
