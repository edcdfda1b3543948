"""Prefix sums, cycles, completeness by bitmaps, versions, whole listings."""

from __future__ import annotations

import os
import random
import subprocess
import sys
import tempfile

import pytest
from helpers import rows
from pyspark.sql import functions as F

from quartermaster.operators import aggregates as A
from quartermaster.operators import closure as CL
from quartermaster.operators import joins as J
from quartermaster.sinks import writers as K
from quartermaster.sources import files as SRC


def test_bundle_offsets_equal_a_running_sum(spark):
    rng = random.Random(3)
    some = [(rng.choice(["hot", "hot", "hot", "b", None]), f"m{k:04d}", rng.choice([None, 0, 5, 100])) for k in range(600)]
    rng.shuffle(some)
    df = spark.createDataFrame(some, "bundle string, member string, size long").repartition(5)
    at, want = {}, []
    for b, m, n in sorted(some, key=lambda r: (str(r[0]), r[1])):
        want.append((b, m, at.get(b, 0), n or 0))
        at[b] = at.get(b, 0) + (n or 0)
    got = A.bundle_offsets(df, "bundle", "member", "size")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert A.bundle_offsets(df.where("false"), "bundle", "member", "size").count() == 0


def test_hot_bundle_is_spread_over_the_ranges(spark):
    df = spark.range(8000).select(F.lit("one").alias("bundle"), F.format_string("%06d", "id").alias("member"),
                                  F.lit(1).alias("size"))
    out = A.prefix_sum(df.withColumn("length", F.lit(1)), ["member"], ["bundle"], "length", num_partitions=8)
    assert out.where("offset != cast(member as int)").count() == 0
    window = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Window [sum(__qm_value" in line]
    # The window over the rows is cut by range, not only by bundle.
    assert any("[__qm_pid" in line.split("windowspecdefinition(")[1] for line in window)
    ranged, pid = A._ranged(df, ["bundle", "member"], 8)
    assert ranged.select(pid.alias("p")).distinct().count() == 8


def test_names_in_use_are_refused(spark):
    df = spark.range(3).withColumn("Position", F.lit(1)).withColumn("offset", F.lit(2))
    with pytest.raises(ValueError, match="position"):
        A.ordinal(df, ["id"])
    with pytest.raises(ValueError, match="offset"):
        A.prefix_sum(df, ["id"], [], "id")
    assert A.ordinal(df, ["id"], name="line").columns == ["id", "Position", "offset", "line"]


def edges(spark, *pairs):
    return spark.createDataFrame(list(pairs), "node string, parent string")


def test_cycles_are_strongly_connected_components(spark):
    rng = random.Random(9)
    for _ in range(4):
        pairs = {(f"n{rng.randint(0, 14)}", f"n{rng.randint(0, 14)}") for _ in range(20)}
        reach = set(pairs)
        while True:
            more = reach | {(a, d) for a, b in reach for c, d in reach if b == c}
            if more == reach:
                break
            reach = more
        want = sorted((a, min(b for x, b in reach if x == a and (b, a) in reach)) for a in {a for a, b in reach if a == b})
        assert rows(CL.cycles(CL.dependency_closure(edges(spark, *pairs)))) == want


def test_order_of_cyclic_input(spark):
    e = edges(spark, ("a", "b"), ("b", "c"), ("c", "b"), ("d", "a"), ("b", "e"), ("self", "self"))
    nodes = spark.createDataFrame([(x,) for x in ("a", "b", "c", "d", "e", "self")], "node string")
    closure = CL.dependency_closure(e)
    with pytest.raises(ValueError, match="cyclic"):
        CL.dependency_order(nodes, closure)
    got = [tuple(r) for r in CL.dependency_order(nodes, closure, on_cycle="group").collect()]
    assert got == [("e", 0, None), ("self", 0, "self"), ("b", 1, "b"), ("c", 1, "b"), ("a", 3, None), ("d", 4, None)]


def test_bitmap_completeness_equals_the_join(spark):
    rng = random.Random(5)
    req = [(rng.choice(["x", "y", "z", None]), rng.choice([None, 0, 1, 5, 32767, 32768, 70000])) for _ in range(60)]
    have = [(rng.choice(["x", "y", "w", None]), rng.choice([None, -3, 0, 1, 5, 32768, 99999])) for _ in range(60)]
    r = spark.createDataFrame(req, "g string, m long")
    p = spark.createDataFrame(have, "pg string, pm long")
    want = J.completeness(r, p, "g", "m", "pg", "pm")
    assert rows(J.completeness_bitmap(r, p, "g", "m", "pg", "pm"), *want.columns) == rows(want)
    names = [str(m) for m in (0, 1, 5, 32767, 32768, 70000)]
    as_text = [df.withColumn(c, F.col(c).cast("string")) for df, c in ((r, "m"), (p, "pm"))]
    assert rows(J.completeness_bitmap(*as_text, "g", "m", "pg", "pm", domain=names), *want.columns) == rows(want)
    with pytest.raises(Exception, match="required member without a number"):
        J.completeness_bitmap(*as_text, "g", "m", "pg", "pm", domain=names[:2]).collect()


def test_bitmap_completeness_of_a_million_members(spark):
    required = spark.range(1_000_000).select(F.lit("big").alias("g"), F.col("id").alias("m"))
    present = required.where("m % 10 != 3")
    out = J.completeness_bitmap(required, present.unionByName(present), "g", "m")
    assert [tuple(r) for r in out.collect()] == [("big", 1_000_000, 900_000, 100_000, False)]
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    for line in plan.splitlines():  # what is shuffled first are partial bitmaps
        if "Exchange" in line:
            assert "__qm_n" not in line
    assert "partial_bitmap_construct_agg" in plan


def test_versions_switch_at_once(spark, scratch):
    path = scratch("versions")
    with pytest.raises(FileNotFoundError):
        K.read_versioned(spark, path)
    K.write_versioned(spark.range(3), path)
    old = K.read_versioned(spark, path)
    K.write_versioned(spark.range(5), path)
    assert K.read_versioned(spark, path).count() == 5
    assert old.count() == 3  # a reader that resolved the pointer before still reads its version
    K.write_versioned(spark.range(6), path)
    assert sorted(K._versions(spark, path)) == [2, 3]
    with pytest.raises(Exception, match="boom"):
        K.write_versioned(spark.range(9).select(F.raise_error(F.lit("boom")).alias("id")), path)
    assert K.read_versioned(spark, path).count() == 6
    K.write_versioned(spark.range(7), path)
    assert K.read_versioned(spark, path).count() == 7


KILLED = """
import os, sys
sys.path.insert(0, {root!r})
from quartermaster.session import build_session
from quartermaster.sinks import writers as K
spark = build_session("local[2]", 2)
K.write_versioned(spark.range(4), {path!r})
K.replace_file = lambda *a: os._exit(7)  # the job dies after the rows, before the switch
K.write_versioned(spark.range(100), {path!r})
"""


def test_killed_between_rows_and_switch_leaves_the_old_rows(spark):
    path = tempfile.mkdtemp(prefix="qm-versions-")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", KILLED.format(root=root, path=path)], capture_output=True, timeout=300)
    assert done.returncode == 7, done.stderr[-2000:]
    assert K.read_versioned(spark, path).count() == 4
    K.write_versioned(spark.range(5), path)
    assert K.read_versioned(spark, path).count() == 5


def test_whole_listing_equals_a_walk(spark):
    root = tempfile.mkdtemp(prefix="qm-walk-")
    for rel in ("a.txt", "_hidden.txt", ".dot", "_f/x", "f/.g/y y.txt", "f/SUMS.txt", "SUMS.txt", "f/h/i/j/k", "e=1/_part", "é/ü"):
        os.makedirs(os.path.dirname(os.path.join(root, rel)), exist_ok=True)
        with open(os.path.join(root, rel), "w") as fh:
            fh.write(rel)
    os.makedirs(os.path.join(root, "empty"))
    os.symlink(root, os.path.join(root, "f", "loop"))
    os.symlink(os.path.join(root, "a.txt"), os.path.join(root, "link"))
    want = sorted((os.path.join(at, n), n, os.path.getsize(os.path.join(at, n))) for at, _, names in os.walk(root)
                  for n in names if n != "SUMS.txt" and n != "link")
    for given in (root, f"file:{root}", f"file://{root}/"):
        got = SRC.file_inventory_all(spark, given, exclude_names=["SUMS.txt"])
        assert sorted((r["path"].removeprefix("file:"), r["name"], r["length"])
                      for r in got.collect()) == want
    assert got.where("modified is null").count() == 0
