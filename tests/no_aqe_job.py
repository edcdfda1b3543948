"""Run by test_no_aqe.py in its own process: every registered query against
its oracle in a session with AQE off and Spark's default 200 shuffle
partitions, so correctness does not depend on runtime re-planning."""

from __future__ import annotations

import os
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from oracle_check import rows_of  # noqa: E402
from quartermaster.session import TABLES  # noqa: E402


def main(sf_dir: str) -> int:
    spark = (SparkSession.builder.master("local[4]").appName("qm-no-aqe")
             .config("spark.sql.adaptive.enabled", "false").config("spark.ui.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    import __spark_entry__ as E
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    oracles, bad, checked = E.oracle_sql(), 0, 0
    for name, fn in E.queries().items():
        df = fn(spark, sf_dir)
        got = [tuple(r) for r in df.collect()]
        if name in oracles:
            res = con.execute(oracles[name])
            want = res.fetchall()
            cols = [c[0] for c in res.description]
            checked += 1
            if Counter(rows_of(df.columns, got)) != Counter(rows_of(cols, want)):
                bad += 1
                print("mismatch", name)
    print("checked", checked, "bad", bad)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"))
