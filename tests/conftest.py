from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

sys.path.insert(0, os.path.join(ROOT, "tests"))

from helpers import SF01  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from quartermaster.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app_name="quartermaster-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from quartermaster.session import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF01}/{t}.parquet')")
    return con


@pytest.fixture
def scratch(spark):
    from quartermaster.session import scratch_dir
    return lambda label="t": scratch_dir(spark, label)

