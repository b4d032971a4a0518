"""Run each catalog query on Spark and its oracle SQL on DuckDB and compare.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
Compares column names, row counts and order-insensitive values (doubles to
1e-9 relative).  Prints one line per key and exits non-zero on a mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, decimal.Decimal)) and not isinstance(v, bool):
        return (2, float(v))
    if isinstance(v, float):
        if math.isnan(v):
            return (3, "nan")
        return (2, float(v))
    if isinstance(v, dt.datetime):
        return (4, v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return (4, v.isoformat())
    if isinstance(v, dict):
        return (5, str(sorted(v.items())))
    return (6, str(v))


def _close(a, b) -> bool:
    if a[0] != b[0]:
        return False
    if a[0] == 2:
        x, y = a[1], b[1]
        if os.environ.get("ORACLE_EXACT"):
            return x == y
        return x == y or abs(x - y) <= 1e-9 * max(1.0, abs(x), abs(y))
    return a == b


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns differ: spark={sorted(spark_cols)} duck={sorted(duck_cols)}"
    if len(spark_rows) != len(duck_rows):
        return f"row count differs: spark={len(spark_rows)} duck={len(duck_rows)}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    s = sorted(tuple(_norm(r[i]) for i in si) for r in spark_rows)
    d = sorted(tuple(_norm(r[i]) for i in di) for r in duck_rows)
    for a, b in zip(s, d):
        if not all(_close(x, y) for x, y in zip(a, b)):
            return f"values differ, first: spark={a} duck={b}"
    return None


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from claimsdq.session import local_session
    spark = local_session()
    con = duck_conn(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for k, f in qs.items():
        if only and k not in only:
            continue
        t = time.time()
        try:
            df = f(spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            stypes = dict(df.dtypes)
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t
        if k not in sqls:
            print(f"SKIP {k}: no oracle ({len(srows)} rows, {ts:.2f}s)")
            continue
        try:
            res = con.execute(sqls[k])
            dcols = [d[0] for d in res.description]
            dtypes = {d[0]: str(d[1]) for d in res.description}
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: duckdb error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        err = compare(srows, scols, drows, dcols)
        types = {c: (stypes.get(c), dtypes.get(c)) for c in scols}
        if err:
            bad += 1
            print(f"FAIL {k}: {err}\n      types={types}")
        else:
            print(f"ok   {k}: {len(srows)} rows {ts:.2f}s")
            if "-v" in only:
                print(f"      types={types}")
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
