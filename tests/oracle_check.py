"""Run registered queries against their DuckDB twins and report differences.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tessera.sources.driver import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns differ: {sorted(spark_cols)} vs {sorted(duck_cols)}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=repr)
    if len(a) != len(b):
        return f"rows differ: {len(a)} vs {len(b)}"
    sa, sb = set(a), set(b)
    only_a, only_b = sorted(sa - sb, key=repr), sorted(sb - sa, key=repr)
    if only_a or only_b:
        return (f"{len(only_a)} spark-only / {len(only_b)} duckdb-only rows; cols={order}\n"
                f"   spark: {only_a[:2]}\n   duckdb: {only_b[:2]}")
    return None


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from __spark_entry__ import oracle_sql, queries
    from tessera.session import build_session

    spark = build_session()
    con = duck(sf_dir)
    qs, sql = queries(), oracle_sql()
    failed = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{name}: SPARK ERROR {type(e).__name__}: {str(e)[:400]}")
            failed += 1
            continue
        ts = time.time() - t0
        if name not in sql:
            print(f"{name}: {len(rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sql[name])
            drows = cur.fetchall()
            dcols = [d[0] for d in cur.description]
        except Exception as e:  # noqa: BLE001
            print(f"{name}: DUCKDB ERROR {str(e)[:400]}")
            failed += 1
            continue
        msg = compare(rows, cols, drows, dcols)
        if msg:
            failed += 1
        print(f"{name}: {'MISMATCH ' + msg if msg else 'ok'} ({len(rows)} rows, {ts:.1f}s)")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
