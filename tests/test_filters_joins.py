"""Layer 1 and 3: filters and joins on the literal fixtures."""

from __future__ import annotations


import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import rows
from quartermaster.functions import predicates as P
from quartermaster.operators import closure as CL
from quartermaster.operators import filters as FL
from quartermaster.operators import joins as J

LISTING = ["game-linux:4.4-f41", "registry.example/someone/game-linux:4.4-f41", "fedora:41",
           "game-web:4x4-f41", "game-osx"]


@pytest.fixture
def listing(spark):
    return spark.createDataFrame([(x,) for x in LISTING], "line string")


def test_filter_contains_fixture(listing):
    got = [r.line for r in FL.filter_contains(listing, "line", "game", "/").collect()]
    assert got == ["game-linux:4.4-f41", "game-web:4x4-f41", "game-osx"]


def test_filter_exact_dots_are_not_wildcards(listing):
    assert FL.filter_exact(listing, "line", "game-web:4.4-f41").count() == 0
    assert FL.filter_exact(listing, "line", "game-web:4x4-f41").count() == 1


def test_allow_list_literal_and_table(spark):
    domain = ["linux", "windows", "web", "android", "osx", "ios"]
    df = spark.createDataFrame([("linux",), ("Linux",), ("ios",), ("bsd",)], "t string")
    assert rows(FL.allow_list(df, "t", domain)) == [("ios",), ("linux",)]
    allowed = spark.createDataFrame([(d,) for d in domain + ["linux"]], "name string")
    assert rows(FL.allow_list(df, "t", allowed, "name")) == [("ios",), ("linux",)]


def test_all_present_null_and_empty_fail(spark):
    df = spark.createDataFrame([("r", "u", "t"), ("r", "", "t"), ("r", None, "t")], "a string, b string, c string")
    assert FL.all_present(df, ["a", "b", "c"]).count() == 1


def test_exclude_prefixes_on_base_name(spark):
    df = spark.createDataFrame([("dir/game.zip",), ("game/other.zip",), ("x/lib.so",)], "p string")
    assert rows(FL.exclude_prefixes(df, "p", ["game", "lib"])) == [("game/other.zip",)]


def test_split_valid_permissive_partitions_input(spark):
    df = spark.createDataFrame([("linux",), ("bsd",), (None,)], "t string")
    good, bad = FL.split_valid(df, P.is_allowed("t", ["linux"]))
    assert good.count() + bad.count() == df.count()
    assert rows(good) == [("linux",)]
    assert bad.count() == 2  # a null rule result is a reject


def test_split_valid_strict_raises(spark):
    df = spark.createDataFrame([("linux",), ("bsd",)], "t string")
    with pytest.raises(PySparkException):
        FL.split_valid(df, P.is_allowed("t", ["linux"]), mode="strict").collect()


def test_missing_work_null_keys_are_missing(spark):
    req = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    have = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    got = {r.k for r in J.missing_work(req, have, "k").collect()}
    assert got == {2, None}


def test_unique_mapping_guard(spark):
    df = spark.createDataFrame([("a",)], "k string")
    dup = spark.createDataFrame([("a", "1"), ("a", "2")], "k string, v string")
    with pytest.raises(PySparkException):
        J.map_lookup(df, dup, "k").collect()
    ok = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    assert rows(J.map_lookup(df, ok, "k")) == [("a", "1")]


def test_pair_merge_needs_both(spark):
    df = spark.createDataFrame([("editor", "arm64", "e1"), ("editor", "x86_64", "e2"),
                                ("template", "arm64", "t1")], "target string, arch string, f string")
    got = J.pair_merge(df, "target", "arch", "arm64", "x86_64", "f").collect()
    assert [(r.target, r.first_arm64, r.first_x86_64) for r in got] == [("editor", "e1", "e2")]


def test_orphans(spark):
    child = spark.createDataFrame([("a",), ("b",), ("c",)], "img string")
    parent = spark.createDataFrame([("b",)], "used string")
    assert rows(J.orphan_rows(child, parent, "img", "used")) == [("a",), ("c",)]
    assert rows(J.drop_orphans(child, parent, "img", "used")) == [("b",)]
    assert J.orphan_rows(parent.withColumnRenamed("used", "img"), child, "img").count() == 0


def test_nearest_ancestor_fixture(spark):
    anchors = spark.createDataFrame([("/a",), ("/a/b",), ("/",)], "anchor string")
    paths = spark.createDataFrame([(1, "/a/b/c"), (2, "/a/x"), (3, "/z"), (4, "/a/b")], "id int, path string")
    got = {r.id: (r.anchor, r.levels_up) for r in J.nearest_ancestor(paths, anchors, "id", "path").collect()}
    assert got == {1: ("/a/b", 1), 2: ("/a", 1), 3: ("/", 1), 4: ("/a/b", 0)}
    no_root = anchors.filter(F.col("anchor") != "/")
    got = {r.id: r.anchor for r in J.nearest_ancestor(paths, no_root, "id", "path").collect()}
    assert got[3] is None


def test_ancestors_unrooted(spark):
    paths = spark.createDataFrame([(1, "h/en/1")], "id int, path string")
    got = sorted((r.levels_up, r.ancestor) for r in J.ancestors(paths, "path").collect())
    assert got == [(0, "h/en/1"), (1, "h/en"), (2, "h")]


def test_completeness_fixture(spark):
    required = [("apple_sdk", m) for m in ("MacOSX.sdk", "iPhoneOS.sdk", "iPhoneSimulator.sdk")] + \
        [("android_editor", m) for m in ("editor.apk", "horizonos.apk", "editor.aab")] + \
        [("web_mono", m) for m in ("debug.zip", "release.zip")] + \
        [("ios_classical", f"lib{i}") for i in range(4)] + [("ios_mono", f"lib{i}") for i in range(4)]
    present = [("apple_sdk", "MacOSX.sdk"), ("apple_sdk", "iPhoneOS.sdk"), ("apple_sdk", "iPhoneSimulator.sdk")] + \
        [("ios_classical", f"lib{i}") for i in range(4)] * 2 + [("ios_mono", f"lib{i}") for i in range(4)]
    req = spark.createDataFrame(required, "grp string, member string")
    have = spark.createDataFrame(present, "grp string, member string")
    got = {r.grp: (r.complete, r.n_missing) for r in J.completeness(req, have, "grp", "member").collect()}
    assert got == {"apple_sdk": (True, 0), "android_editor": (False, 3), "web_mono": (False, 2),
                   "ios_classical": (True, 0), "ios_mono": (True, 0)}
    assert J.missing_members(req, have, "grp", "member").count() == 5




def test_closure_base_images_fixture(spark):
    edges = spark.createDataFrame([("linux", "fedora"), ("windows", "fedora"), ("web", "fedora"),
                                   ("android", "fedora"), ("xcode", "fedora"), ("osx", "fedora"),
                                   ("ios", "osx")], "node string, parent string")
    cl = CL.dependency_closure(edges)
    got = {(r.node, r.ancestor): r.depth for r in cl.collect()}
    assert len(got) == 8 and got[("ios", "fedora")] == 2
    assert all(n != a for n, a in got)  # no (x, x) on acyclic input
    order = [r.node for r in CL.dependency_order(
        edges.select("node").union(edges.select("parent")), cl).collect()]
    assert order[0] == "fedora" and order.index("osx") < order.index("ios")


def test_closure_direct_dependency_list(spark):
    deps = spark.createDataFrame([("osx", "xcode"), ("ios", "osx,xcode")], "node string, deps string")
    edges = CL.direct_edges(deps, "node", "deps")
    assert rows(edges) == [("ios", "osx"), ("ios", "xcode"), ("osx", "xcode")]
    got = {(r.node, r.ancestor): r.depth for r in CL.dependency_closure(edges).collect()}
    assert got == {("osx", "xcode"): 1, ("ios", "osx"): 1, ("ios", "xcode"): 1}


def test_closure_stops_on_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "node string, parent string")
    got = {(r.node, r.ancestor): r.depth for r in CL.dependency_closure(edges).collect()}
    assert len(got) == 9 and got[("a", "a")] == 3 and got[("a", "c")] == 2


def test_closure_shortest_depth_on_dag(spark):
    edges = spark.createDataFrame([("d", "c"), ("c", "b"), ("b", "a"), ("d", "a")], "node string, parent string")
    got = {(r.node, r.ancestor): r.depth for r in CL.dependency_closure(edges).collect()}
    assert got[("d", "a")] == 1 and len(got) == 6


def test_closure_of_the_part_tree(spark):
    from helpers import SF01
    part = spark.read.parquet(f"{SF01}/part.parquet")
    edges = (part.select(F.col("p_partkey").alias("node"), F.expr("p_partkey div 2").alias("parent"))
                 .filter(F.col("node") != F.col("parent")))
    a = CL.dependency_closure(edges)
    assert a.count() == 19953 and a.agg(F.max("depth")).first()[0] == 11


def test_closure_of_a_long_chain_doubles(spark):
    n = 400
    found = CL.dependency_closure(spark.range(n).selectExpr("id as node", "id + 1 as parent"))
    assert found.count() == n * (n + 1) // 2
    assert found.filter("depth <> ancestor - node").count() == 0


def test_nearest_ancestor_keeps_repeated_rows(spark):
    paths = spark.createDataFrame([(1, "/a/b"), (1, "/a/b"), (2, "x")], "id int, path string")
    anchors = spark.createDataFrame([("/a",)], "anchor string")
    got = sorted((r.id, r.anchor) for r in J.nearest_ancestor(paths, anchors, "id", "path").collect()
                 if r.anchor)
    assert got == [(1, "/a"), (1, "/a")]


def test_pair_merge_keeps_small_measures(spark):
    df = spark.createDataFrame([("k", "a", 1, 0.004), ("k", "a", 2, 0.004), ("k", "b", 3, 0.001)],
                               "k string, v string, m int, x double")
    r = J.pair_merge(df, "k", "v", "a", "b", member="m", measure="x").first()
    assert (r.x_a, r.x_b) == (0.008, 0.001)



def test_closure_hot_ancestor_is_exact(spark):
    # Node 0 is the parent of 2000 nodes (a hub) and has a parent itself;
    # 100 more nodes hang below the hub's children, so the hub is hot in two rounds.
    star = [(i, 0) for i in range(1, 2001)] + [(0, -1)] + [(2000 + i, i) for i in range(1, 101)]
    edges = spark.createDataFrame(star, "node long, parent long")
    hot = CL.dependency_closure(edges)
    assert hot.count() == 2000 * 2 + 1 + 100 * 3
    assert {r.depth for r in hot.filter("node = 2001").collect()} == {1, 2, 3}


def test_missing_work_keeps_null_and_absent_keys(spark):
    listing = spark.range(0, 50000).select((F.col("id") * 3).alias("img"))
    wanted = spark.createDataFrame([(0,), (1,), (3,), (4,), (None,), (149997,), (150000,)], "k long")
    assert {r.k for r in J.missing_work(wanted, listing, "k", "img").collect()} == {1, 4, None, 150000}
