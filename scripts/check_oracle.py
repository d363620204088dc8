"""Run registered Spark queries and their DuckDB oracle SQL side by side.

usage: python scripts/check_oracle.py [--sf DIR] [name ...]

Compares column names, row counts and an order-insensitive multiset of
canonicalised rows (floats rounded to 6 places).  Prints one line per query.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tests"))

import duckdb  # noqa: E402
from compare import rows  # noqa: E402

from loomis.plans.bindings import TABLES  # noqa: E402
from loomis.plans.registry import load_all  # noqa: E402
from loomis.session import build_session  # noqa: E402


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    queries, oracle = load_all()
    names = args.names or sorted(queries)
    spark = build_session(shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            sp = queries[n](spark, args.sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SPARK {n}: {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if n not in oracle:
            print(f"ROWS-ONLY  {n}: {len(sp)} rows  cols={list(sp.columns)}  {ts:.1f}s")
            continue
        try:
            dk = con.execute(oracle[n]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SQL   {n}: {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        sc, sr = rows(sp)
        dc, dr = rows(dk)
        if sc != dc:
            print(f"COLS       {n}: spark={sc} duck={dc}")
            bad += 1
        elif len(sp) != len(dk):
            print(f"COUNT      {n}: spark={len(sp)} duck={len(dk)}")
            bad += 1
        elif sr != dr:
            only_s = list((sr - dr).elements())[:3]
            only_d = list((dr - sr).elements())[:3]
            print(f"VALUES     {n}: {len(sp)} rows; spark-only {only_s}\n           duck-only {only_d}")
            bad += 1
        else:
            print(f"OK         {n}: {len(sp)} rows  {ts:.1f}s")
    print(f"{len(names) - bad}/{len(names)} ok")
    spark.stop()


if __name__ == "__main__":
    main()
