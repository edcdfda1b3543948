"""Layer 2: every registered query against its DuckDB oracle at sf0.01."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from quartermaster.sources.files import file_inventory, glob_scan

import __spark_entry__ as E
from helpers import SF001, SF01

ORACLES = E.oracle_sql()
QUERIES = E.queries()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF01)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    o_cols = [c[0] for c in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert _multiset(df.columns, s_rows) == _multiset(o_cols, o_rows)


def test_every_query_has_an_oracle():
    from quartermaster.plans import catalog
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert [f.name for f in df.schema.fields] == ["build_type", "n_customers", "n_complete"]
    got = df.collect()
    assert sum(r.n_customers for r in got) == 150


def test_survey_probe_numbers(spark):
    assert QUERIES["j1_missing_work"](spark, SF01).count() == 257
    done = QUERIES["j7_completeness"](spark, SF01)
    assert done.count() == 1500
    assert done.filter("complete").count() == 1332
    assert QUERIES["j8_dependency_closure"](spark, SF01).count() == 19953
    assert QUERIES["h1_digest_sha256"](spark, SF01).select("digest").distinct().count() == 927
    assert QUERIES["a5_resolve_layers"](spark, SF01).count() == 750


def test_sha512_manifest_against_hashlib(spark):
    import hashlib

    import pyarrow.parquet as pq
    from quartermaster.functions.columns import digest_manifest
    docs = pq.read_table(f"{SF001}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = {str(d["doc_id"]): hashlib.sha512(d["text"].encode("utf-8")).hexdigest() for d in docs}
    table = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {r.name: r.digest for r in digest_manifest(table, "doc_id", "text", 512).collect()}
    assert got == want


def test_file_inventory_against_os_walk(spark):
    import os
    want = {}
    for folder, _, files in os.walk(SF001):
        for f in files:
            if f != "_SUCCESS" and not f.startswith((".", "_")):
                want[f] = os.path.getsize(os.path.join(folder, f))
    got = {r.name: r.length for r in file_inventory(spark, SF001, exclude_names=["_SUCCESS"]).collect()}
    assert got == want


def test_glob_scan_against_fnmatch(spark):
    import fnmatch
    import os
    want = sorted(f for f in os.listdir(SF001) if fnmatch.fnmatchcase(f, "[lo]*.parquet"))
    got = sorted(r.name for r in glob_scan(spark, SF001, "[lo]*.parquet").collect())
    assert got == want == ["labels.parquet", "lineitem.parquet", "orders.parquet"]
