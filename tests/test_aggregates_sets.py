"""Aggregates, ordinals, set operations and matrices."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import SF01, rows
from quartermaster.operators import aggregates as A
from quartermaster.operators import sets as S
from quartermaster.session import table

TYPES = ["linux", "windows", "web", "android", "osx", "ios"]


def test_resolve_layers_fixture(spark):
    df = spark.createDataFrame([("registry", 0, 0, "registry.example"), ("build_type", 0, 0, "all"),
                                ("build_type", 1, 1, "classical"), ("build_type", 1, 2, "mono"),
                                ("build_name", 0, 0, "custom_build"), ("build_name", 1, 1, "")],
                               "key string, layer int, seq int, value string")
    got = {r.key: r.value for r in A.resolve_layers(df, "key", "layer", "seq", "value").collect()}
    assert got == {"registry": "registry.example", "build_type": "mono", "build_name": ""}


def test_resolve_layers_null_winner_wins(spark):
    df = spark.createDataFrame([("k", 0, 0, "x"), ("k", 1, 0, None)], "key string, layer int, seq int, value string")
    assert A.resolve_layers(df, "key", "layer", "seq", "value").first().value is None


def test_distinct_selection(spark):
    df = spark.createDataFrame([("linux",), ("linux",), ("ios",)], "t string")
    assert rows(A.distinct_selection(df, "t")) == [("ios",), ("linux",)]


def test_bundle_summary_counts_sum_to_input(spark):
    docs = table(spark, SF01, "documents")
    summ = A.bundle_summary(docs, "source", "n_chars")
    assert summ.agg(F.sum("n_members")).first()[0] == docs.count()
    mem = A.bundle_members(docs, "source", "doc_id")
    per = {r.source: r.c for r in mem.groupBy("source").agg(F.max("position").alias("c")).collect()}
    assert per == {r.source: r.n_members for r in summ.collect()}


def test_nonempty_guard(spark):
    empty = spark.createDataFrame([], "x int")
    with pytest.raises(PySparkException):
        A.nonempty_guard(empty, "release is empty").collect()
    with pytest.raises(RuntimeError):
        A.require_nonempty(empty)
    assert A.nonempty_guard(spark.range(3)).first().n == 3


def test_ordinal_exact_under_skew(spark):
    # One key holds a third of all rows, spread over many ranges.
    hot = spark.range(0, 3000).select(F.lit(0).alias("k"), F.col("id").alias("seq"))
    rest = spark.range(0, 6000).select((F.col("id") % 97 + 1).alias("k"), F.col("id").alias("seq"))
    df = hot.unionByName(rest)
    got = A.ordinal(df, ["seq"], ["k"], num_partitions=16)
    want = df.withColumn("position", F.row_number().over(Window.partitionBy("k").orderBy("seq")))
    assert got.select("k", "seq", "position").exceptAll(want.select("k", "seq", "position")).count() == 0
    assert got.count() == df.count()


def test_collect_args_keeps_repeats_in_order(spark):
    df = spark.createDataFrame([("c", 2, "linux"), ("c", 1, "ios"), ("c", 3, "linux")],
                               "key string, seq int, value string")
    got = [(r.position, r.value) for r in A.collect_args(df, "key", "seq", "value").orderBy("position").collect()]
    assert got == [(1, "ios"), (2, "linux"), (3, "linux")]
    assert A.args_count(df, "key").first().n_args == 3


def test_ordered_manifest_byte_order(spark):
    df = spark.createDataFrame([("a",), ("B",), ("_",), ("b",)], "name string")
    assert [r.name for r in S.ordered_manifest(df, "name").collect()] == ["B", "_", "a", "b"]
    pos = S.ordered_manifest(df, "name", with_position=True).collect()
    assert [(r.position, r.name) for r in pos] == [(1, "B"), (2, "_"), (3, "a"), (4, "b")]


def test_expand_all_fixture(spark):
    sel = spark.createDataFrame([(1, "all"), (1, "linux"), (2, "ios"), (2, "ios")], "req int, t string")
    domain = spark.createDataFrame([(t,) for t in TYPES + ["all"]], "name string")
    got = rows(S.expand_all(sel, "t", domain, "name", keys=["req"]))
    assert got == sorted([(1, t) for t in TYPES] + [(2, "ios")])
    lit = rows(S.expand_all(sel, "t", TYPES, keys=["req"]))
    assert lit == got


def test_expand_all_domain_bound(spark):
    sel = spark.createDataFrame([(1, "all")], "req int, t string")
    big = spark.range(50).select(F.col("id").cast("string").alias("name"))
    # Raised inside the scalar subquery; Spark may surface it wrapped.
    with pytest.raises(Exception, match="more than 10 values"):
        S.expand_all(sel, "t", big, "name", keys=["req"], max_domain=10).collect()


def test_union_sets_second_wins(spark):
    a = spark.createDataFrame([("icu.dat", "classical"), ("a.zip", "classical")], "file string, by string")
    b = spark.createDataFrame([("icu.dat", "mono"), ("b.zip", "mono")], "file string, by string")
    got = {r.file: (r.by, r.source) for r in S.union_sets(a, b, "file").collect()}
    assert got == {"icu.dat": ("mono", "b"), "a.zip": ("classical", "a"), "b.zip": ("mono", "b")}


def test_expand_matrix_counts(spark):
    # threads x link x target for one platform, with cells switched off.
    base = spark.createDataFrame([("web",)], "platform string")
    m = S.expand_matrix(base, {"threads": ["yes", "no"], "link": ["static", "dynamic"],
                               "target": ["editor", "debug", "release"]},
                        exclusions=[{"threads": "no", "target": "editor"}, {"link": "dynamic", "target": "editor"}])
    assert m.count() == 12 - 3
    dims = spark.createDataFrame([("classical",), ("mono",)], "flavour string")
    m2 = S.expand_matrix(base, {"flavour": dims}, exclusions=[{"platform": "web", "flavour": "mono"}])
    assert rows(m2) == [("web", "classical")]


def test_expand_matrix_web_build_runs(spark):
    # Web compile runs: flavour x target x dynamic link x threads, with mono
    # switched off and the editor built only with threads and no dynamic link.
    base = spark.createDataFrame([("web",)], "platform string")
    runs = S.expand_matrix(
        base,
        {"flavour": ["classical", "mono"], "target": ["template_debug", "template_release", "editor"],
         "dlink": ["no", "yes"], "threads": ["yes", "no"]},
        exclusions=[{"flavour": "mono"}, {"target": "editor", "dlink": "yes"},
                    {"target": "editor", "threads": "no"}])
    by_flavour = {r.flavour: r["count"] for r in runs.groupBy("flavour").count().collect()}
    assert by_flavour == {"classical": 9}
    assert runs.filter("target = 'editor'").count() == 1


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([("a", "x"), (None, "z"), (None, "y"), ("b", None)], "g string, m string")
    got = {(r.g, r.position, r.m) for r in A.bundle_members(df, "g", "m").collect()}
    assert got == {("a", 1, "x"), (None, 1, "y"), (None, 2, "z"), ("b", 1, None)}


def test_ordinal_evaluates_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)
    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(500).mapInArrow(count, "id long")
    assert A.ordinal(df, ["id"]).count() == 500
    assert seen.value == 500


def test_resolve_layers_same_answer_for_every_type(spark):
    rows_ = [("k", 0, 1, "10"), ("k", 0, None, "20"), ("z", 1, None, "40"), ("z", 0, 5, "50")]
    df = spark.createDataFrame(rows_, "k string, layer int, seq int, v string")
    text = {r.k: r.value for r in A.resolve_layers(df, "k", "layer", "seq", "v").collect()}
    ints = {r.k: r.value for r in A.resolve_layers(df.withColumn("v", F.col("v").cast("int")),
                                                   "k", "layer", "seq", "v").collect()}
    assert text == {"k": "10", "z": "40"} and ints == {"k": 10, "z": 40}
