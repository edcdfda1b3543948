"""Time the DuckDB oracle SQL of every query (single-node reference point).

    python scripts/duckdb_times.py /root/testdata/sf0.1 [runs]

Prints one JSON line: median seconds per query over ``runs`` runs after
one warm-up. Queries without an oracle are skipped.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from quartermaster.plans.catalog import ORACLES  # noqa: E402
from quartermaster.session import TABLES  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    runs = int(argv[2]) if len(argv) > 2 else 3
    con = duckdb.connect()
    con.execute(f"set threads = {os.cpu_count() or 8}")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    out = {}
    for name, sql in ORACLES.items():
        con.execute(sql).fetchall()
        ts = []
        for _ in range(runs):
            t0 = time.perf_counter()
            con.execute(sql).fetchall()
            ts.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(ts), 4)
    print(json.dumps({"engine": "duckdb", "sf_dir": sf_dir, "total": round(sum(out.values()), 3),
                      "queries": out}))


if __name__ == "__main__":
    main(sys.argv)
