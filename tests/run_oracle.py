"""Ad-hoc runner: compare every registered query with its oracle at one scale.

usage: python tests/run_oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_compare as oc  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = oc.duck(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for key, fn in entry.queries().items():
        if only and key not in only:
            continue
        t = time.time()
        try:
            sres = oc.spark_rows(fn(spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            print(f"{key}: SPARK ERROR {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t
        if key not in sqls:
            print(f"{key}: rows={len(sres[1])} (no oracle) {ts:.1f}s")
            continue
        try:
            dres = oc.duck_rows(con, sqls[key])
        except Exception as e:  # noqa: BLE001
            print(f"{key}: DUCK ERROR {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        a, b = oc.digest(*sres), oc.digest(*dres)
        ok = a == b
        bad += not ok
        print(f"{key}: {'OK' if ok else 'MISMATCH'} rows spark={a[0]} duck={b[0]} {ts:.1f}s")
        if not ok:
            print(oc.diff(sres, dres))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
