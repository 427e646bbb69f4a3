"""Run registered Spark jobs and their DuckDB oracles side by side.

Compares row count, column names and an order-insensitive hash of the values,
the same three checks the driver records.  Usable from pytest and as a CLI:

    python tests/oracle_harness.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(keyed).encode()).hexdigest()


def compare(spark, con, name: str, sf_dir: str) -> dict:
    from __spark_entry__ import oracle_sql, queries

    t0 = time.time()
    df = queries()[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    sql = oracle_sql().get(name)
    if sql is None:
        out["oracle"] = "none"
        return out
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    out.update(
        oracle_rows=len(d_rows),
        columns_match=sorted(s_cols) == sorted(d_cols),
        hash_match=digest(s_cols, s_rows) == digest(d_cols, d_rows),
    )
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
    return out


def main(argv: list[str]) -> int:
    from catalink.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    from __spark_entry__ import queries

    names = argv[2:] or list(queries())
    bad = 0
    for name in names:
        try:
            res = compare(spark, con, name, sf_dir)
        except Exception as exc:  # noqa: BLE001
            res = {"name": name, "error": repr(exc)[:800]}
        ok = res.get("hash_match") and res.get("columns_match") and res.get("spark_rows") == res.get("oracle_rows")
        bad += 0 if ok or res.get("oracle") == "none" else 1
        print(("OK  " if ok else "FAIL") + " " + str(res), flush=True)
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
