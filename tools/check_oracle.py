"""Run registered Spark queries and their DuckDB oracles side by side and compare row multisets.

usage: python tools/check_oracle.py [sf_dir] [name ...]
"""
from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from marquee.plans.catalog import ORACLES, QUERIES, load_all  # noqa: E402
from marquee.session import local_session  # noqa: E402
from marquee.sources.fixtures import TABLES  # noqa: E402


EXACT = "--exact" in sys.argv


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if EXACT else round(v, 5)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows), [cols[i] for i in order]


def main():
    args = [a for a in sys.argv[1:] if a != "--exact"]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    load_all()
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name in names or sorted(QUERIES):
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in ORACLES:
            print(f"ROWS {name}: {len(srows)} rows ({ts:.1f}s), no oracle")
            continue
        try:
            res = con.execute(ORACLES[name])
            dcols = [d[0] for d in res.description]
            dtypes = [str(d[1]) for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        sc, sn = rows_of(scols, srows)
        dc, dn = rows_of(dcols, drows)
        if sn != dn:
            print(f"FAIL {name}: columns spark={sn} duckdb={dn}")
            bad += 1
        elif sc != dc:
            diff1 = list((sc - dc).items())[:3]
            diff2 = list((dc - sc).items())[:3]
            print(f"FAIL {name}: rows spark={len(srows)} duckdb={len(drows)} spark-only={diff1} duck-only={diff2}")
            bad += 1
        else:
            odd = [f"{c}:{t}" for c, t in zip(dcols, dtypes) if t in ("HUGEINT", "DECIMAL") or t.startswith("DECIMAL")]
            print(f"OK   {name}: {len(srows)} rows ({ts:.1f}s)" + (f" duckdb types {odd}" if odd else ""))
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
