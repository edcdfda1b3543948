"""One commit for all sinks, line numbers over splits, digests of big files."""

from __future__ import annotations

import hashlib
import os
import subprocess
import sys
import tempfile

import pytest
from helpers import rows

from quartermaster.sources import files as SRC
from quartermaster.streaming import streams as T


def test_a_batch_shows_in_all_sinks_or_in_none(spark, scratch, monkeypatch):
    root = scratch("t1c")
    spark.range(0, 10).coalesce(1).write.parquet(f"{root}/in")
    schema = spark.range(1).schema

    def run():
        stream = T.table_stream(spark, f"{root}/in", max_files_per_trigger=1)
        T.stream_fan_out_committed(stream, [f"{root}/a", f"{root}/b"], root, f"{root}/ck").awaitTermination()

    def seen():
        return [rows(T.read_committed(spark, f"{root}/{x}", root, schema).select("id")) for x in "ab"]

    assert seen() == [[], []]
    run()
    assert seen() == [rows(spark.range(10))] * 2
    spark.range(10, 15).coalesce(1).write.mode("append").parquet(f"{root}/in")
    whole = T.fan_out

    def first_sink_only(batch, sinks):
        whole(batch, sinks[:1])
        raise RuntimeError("the second sink is full")

    monkeypatch.setattr(T, "fan_out", first_sink_only)
    with pytest.raises(Exception, match="the second sink is full"):
        run()
    assert spark.read.parquet(f"{root}/a").count() == 15  # written there already,
    assert seen() == [rows(spark.range(10))] * 2          # but not shown
    monkeypatch.setattr(T, "fan_out", whole)
    run()
    assert seen() == [rows(spark.range(15))] * 2
    plan = T.read_committed(spark, f"{root}/a", root, schema)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan


def test_line_numbers_hold_over_many_splits(spark):
    root = tempfile.mkdtemp(prefix="qm-lines-")
    want = []
    for name, n in (("a.txt", 5000), ("b.txt", 1), ("c.txt", 700), ("empty.txt", 0)):
        with open(os.path.join(root, name), "w") as fh:
            for k in range(n):
                fh.write(f"{name}-{k}:{'x' * (k % 50)}\n")
                want.append((name, k + 1, f"{name}-{k}"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    try:
        out = SRC.line_scan_numbered(spark, root, ":", ["id", "rest"])
        assert spark.read.text(root).rdd.getNumPartitions() > 30
        got = sorted((os.path.basename(r["path"]), r["line"], r["id"]) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert got == sorted(want)


def test_file_digests_equal_hashlib(spark):
    root = tempfile.mkdtemp(prefix="qm-digest-")
    data = {"a b.bin": os.urandom(3_000_000), "empty": b"", "é.txt": b"x\n", "z.gz": b"not unpacked"}
    for name, body in data.items():
        with open(os.path.join(root, name), "wb") as fh:
            fh.write(body)
    for bits in (256, 512):
        got = {r["name"]: (r["length"], r["digest"]) for r in SRC.file_digests(SRC.file_inventory_all(spark, root), bits).collect()}
        assert got == {n: (len(b), hashlib.new(f"sha{bits}", b).hexdigest()) for n, b in data.items()}


BIG = """
import resource, sys
sys.path.insert(0, {root!r})
import pyarrow as pa
from quartermaster.sources.files import _digest_files
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
(out,) = _digest_files(256)(iter([pa.record_batch([pa.array([{path!r}])], names=["path"])]))
print(out.column(1)[0], out.column(2)[0], resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""


def test_memory_is_flat_on_a_large_sparse_file():
    path = os.path.join(tempfile.mkdtemp(prefix="qm-sparse-"), "big")
    size = 1 << 30
    with open(path, "wb") as fh:
        fh.truncate(size)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", BIG.format(root=root, path=path)], capture_output=True, text=True, timeout=300)
    length, digest, grown_kb = done.stdout.split()
    want, zeros = hashlib.sha256(), bytes(1 << 20)
    for _ in range(size >> 20):
        want.update(zeros)
    assert (int(length), digest) == (size, want.hexdigest())
    assert int(grown_kb) < 64 * 1024
