"""Local twin of the driver's correctness gate: run each catalog query on Spark
and its oracle SQL on DuckDB, compare row count, column names and an
order-insensitive value digest.

    python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(int(v)) if v == v.to_integral() else str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, bool):
        return str(v)
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from ledgerline.session import build_session
    spark = build_session()
    qs, oracles = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    ok_all = True
    for key in keys or list(qs):
        t0 = time.time()
        try:
            sdf = qs[key](spark, sf_dir)
            rows = [tuple(r) for r in sdf.collect()]
            cols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {key}: spark error {type(e).__name__}: {str(e)[:400]}")
            ok_all = False
            continue
        ts = time.time() - t0
        if key not in oracles:
            print(f"ROWS {key}: {len(rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(oracles[key])
            dcols = [c[0] for c in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {key}: duckdb error {str(e)[:400]}")
            ok_all = False
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(dcols, drows)
        same_cols = sorted(cols) == sorted(dcols)
        if h1 == h2 and same_cols and len(rows) == len(drows):
            print(f"OK   {key}: {len(rows)} rows {ts:.1f}s")
        else:
            ok_all = False
            print(f"FAIL {key}: spark {len(rows)} rows cols={sorted(cols)} | duck {len(drows)} rows cols={sorted(dcols)}")
            s1, s2 = set(l1), set(l2)
            for x in sorted(s1 - s2)[:3]:
                print("   spark only:", x[:300])
            for x in sorted(s2 - s1)[:3]:
                print("   duck only: ", x[:300])
    return 0 if ok_all else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
