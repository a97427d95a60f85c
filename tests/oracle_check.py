"""Run every registered query on Spark and its oracle SQL on DuckDB, compare
row count, column names and an order-insensitive value hash.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import json
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int,)):
        return float(v)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat()
    if isinstance(v, (list, tuple)):
        return [norm(x) for x in v]
    if isinstance(v, dict):
        return {k: norm(x) for k, x in v.items()}
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keys = sorted(json.dumps([norm(r[i]) for i in order], default=str) for r in rows)
    return hashlib.sha256("\n".join(keys).encode()).hexdigest(), keys


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    only = [a for a in argv[1:] if not a.startswith("/")]
    from __spark_entry__ import oracle_sql, queries
    from gildhall.session import get_session
    spark = get_session()
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if only and name not in only or name not in sqls:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(s_rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sqls[name])
            d_cols = [c[0] for c in cur.description]
            d_rows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(s_cols) != sorted(d_cols):
            print(f"FAIL {name}: columns spark={s_cols} duck={d_cols}")
            bad += 1
            continue
        hs, ks = digest(s_cols, s_rows)
        hd, kd = digest(d_cols, d_rows)
        if len(s_rows) != len(d_rows) or hs != hd:
            bad += 1
            print(f"FAIL {name}: rows spark={len(s_rows)} duck={len(d_rows)}")
            sk, dk = set(ks), set(kd)
            print("   only spark:", sorted(sk - dk)[:3])
            print("   only duck :", sorted(dk - sk)[:3])
            print("   cols:", sorted(s_cols))
        else:
            print(f"OK   {name}: {len(s_rows)} rows {ts:.1f}s")
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
