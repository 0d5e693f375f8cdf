"""Run registered queries next to their SQL.

usage: python tools/check.py [scale] [key-prefix,key-prefix,…]
"""

import os
import sys
import time

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

import oracle

import tallyspan.plans as plans
from tallyspan.session import local_session


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    only = sys.argv[2].split(",") if len(sys.argv) > 2 else [""]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf_dir)
    bad = []
    for key in plans.QUERIES:
        if not any(key.startswith(p) for p in only):
            continue
        start = time.time()
        try:
            n, notes = oracle.differences(spark, con, sf_dir, key)
        except Exception as e:
            n, notes = 0, [str(e)[:600]]
        print(f"{'FAIL' if notes else 'ok'} {key}: {n} rows {time.time() - start:.2f}s {'; '.join(notes)}", flush=True)
        if notes:
            bad.append(key)
    print("BAD:", bad)


main()
