"""Property tests: each operator against an independent Python model on
generated inputs (one DataFrame per example, so each example is one job)."""

from __future__ import annotations

import fnmatch
import re
from collections import deque

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quartermaster.functions import columns as C
from quartermaster.operators import aggregates as A
from quartermaster.operators import closure as CL
from quartermaster.operators import joins as J

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

text = st.text(alphabet="ab.-x/ 1é😀", max_size=12)


@SETTINGS
@given(st.lists(text, min_size=1, max_size=20),
       st.sampled_from(["a", "b.", "[ab]x", "x", r"\.", "é", "/a"]))
def test_replace_first_matches_python(spark, values, pattern):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.o for r in df.select(C.replace_first("v", pattern, "#").alias("o")).collect()]
    assert got == [re.sub(pattern, "#", v, count=1) for v in values]


def _shell_package(path: str) -> tuple[str, str]:
    """The shell rules, written out literally: strip the suffix, strip the
    directory, cut the name at the first '.<digit>', take the version from
    the first digit to the end."""
    stem = path[:-len(".nupkg")] if path.endswith(".nupkg") else path
    stem = stem.rsplit("/", 1)[-1]
    name = stem
    for i in range(len(stem) - 1):
        if stem[i] == "." and stem[i + 1].isdigit():
            name = stem[:i]
            break
    version = ""
    for i, ch in enumerate(stem):
        if ch.isdigit():
            version = stem[i:]
            break
    return name, version


@SETTINGS
@given(st.lists(st.text(alphabet="Ab2.9-/", min_size=1, max_size=14).map(lambda s: s + ".nupkg"),
                min_size=1, max_size=20))
def test_parse_package_matches_shell_rules(spark, paths):
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = [(r.name, r.version_raw) for r in C.parse_package(df, "path").collect()]
    assert got == [_shell_package(p) for p in paths]


@SETTINGS
@given(st.lists(st.text(alphabet="Gga.z1", max_size=8), min_size=1, max_size=20),
       st.sampled_from(["[Gg]*", "*.z", "g?a*", "*1", "[!G]*", "a"]))
def test_glob_matches_fnmatch(spark, names, glob):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r.name for r in df.filter(F.col("name").rlike(C.glob_to_regex(glob))).collect()]
    assert got == [n for n in names if fnmatch.fnmatchcase(n, glob)]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 9), st.one_of(st.none(), st.integers(0, 3))), min_size=1, max_size=10),
       st.text(alphabet="dev", min_size=1, max_size=3))
def test_compose_version_matches_rule(spark, parts, status):
    rows = [(i, mj, p, status) for i, (mj, p) in enumerate(parts)]
    df = spark.createDataFrame([(r[1], 4, r[2], r[3]) for r in rows], "major int, minor int, patch int, status string")
    got = [r.version_dash for r in C.compose_version(df).collect()]
    want = [(f"{mj}.4.{p}" if p not in (None, 0) else f"{mj}.4") + f"-{status}" for _, mj, p, _ in rows]
    assert got == want


segment = st.sampled_from(["a", "b", "c"])
path = st.lists(segment, max_size=4).map(lambda parts: "/" + "/".join(parts))


@SETTINGS
@given(st.lists(path, min_size=1, max_size=15), st.lists(path, max_size=5))
def test_nearest_ancestor_matches_brute_force(spark, paths, anchors):
    pdf = spark.createDataFrame(list(enumerate(paths)), "id int, path string")
    adf = spark.createDataFrame([(a,) for a in anchors], "anchor string")
    got = {r.id: (r.anchor, r.levels_up) for r in J.nearest_ancestor(pdf, adf, "id", "path").collect()}

    def segs(p):
        return [s for s in p.split("/") if s]

    want = {}
    for i, p in enumerate(paths):
        best = None
        for a in set(anchors):
            sa, sp = segs(a), segs(p)
            if sp[:len(sa)] == sa:
                lv = len(sp) - len(sa)
                if best is None or lv < best[1]:
                    best = ("/" + "/".join(sa), lv)
        want[i] = best if best else (None, None)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 7), st.integers(0, 7)), min_size=1, max_size=20))
def test_closure_matches_bfs(spark, edges):
    df = spark.createDataFrame(edges, "node int, parent int")
    got = {(r.node, r.ancestor): r.depth for r in CL.dependency_closure(df).collect()}
    adj = {}
    for n, p in set(edges):
        adj.setdefault(n, set()).add(p)
    want = {}
    for start in adj:
        dist, queue = {}, deque([(start, 0)])
        while queue:
            cur, d = queue.popleft()
            for nxt in adj.get(cur, ()):
                if nxt not in dist:
                    dist[nxt] = d + 1
                    queue.append((nxt, d + 1))
        want.update({(start, a): d for a, d in dist.items()})
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4)), min_size=1, max_size=20),
       st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4)), max_size=20))
def test_completeness_matches_sets(spark, required, present):
    req = spark.createDataFrame(required, "g int, m int")
    have = spark.createDataFrame(present or [(99, 99)], "g int, m int")
    got = {r.g: (r.n_required, r.n_present, r.complete) for r in J.completeness(req, have, "g", "m").collect()}
    want = {}
    for g in {g for g, _ in required}:
        need = {m for gg, m in required if gg == g}
        hit = need & {m for gg, m in (present or [(99, 99)]) if gg == g}
        want[g] = (len(need), len(hit), need == hit)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 10 ** 6)), min_size=1, max_size=40, unique_by=lambda t: t[1]))
def test_ordinal_matches_sorted_enumeration(spark, rows):
    df = spark.createDataFrame(rows, "k int, seq int")
    got = {(r.k, r.seq): r.position for r in A.ordinal(df, ["seq"], ["k"], num_partitions=5).collect()}
    want = {}
    for k in {k for k, _ in rows}:
        for pos, s in enumerate(sorted(s for kk, s in rows if kk == k), start=1):
            want[(k, s)] = pos
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2"]), st.integers(0, 1), st.integers(0, 5),
                          st.one_of(st.none(), st.sampled_from(["", "x", "y"]))),
                min_size=1, max_size=15, unique_by=lambda t: (t[0], t[1], t[2])))
def test_resolve_layers_matches_last_wins(spark, settings_rows):
    df = spark.createDataFrame(settings_rows, "key string, layer int, seq int, value string")
    got = {r.key: r.value for r in A.resolve_layers(df, "key", "layer", "seq", "value").collect()}
    want = {}
    for key in {r[0] for r in settings_rows}:
        want[key] = max((r for r in settings_rows if r[0] == key), key=lambda r: (r[1], r[2]))[3]
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["a", "b", "all", "c"])), min_size=1, max_size=15),
       st.lists(st.sampled_from(["a", "b", "c", "d", "all"]), min_size=1, max_size=6))
def test_expand_all_matches_sets(spark, selection, domain):
    from quartermaster.operators import sets as S
    sel = spark.createDataFrame(selection, "req int, t string")
    dom = spark.createDataFrame([(d,) for d in domain], "name string")
    got = {(r.req, r.t) for r in S.expand_all(sel, "t", dom, "name", keys=["req"]).collect()}
    full = set(domain) - {"all"}
    want = set()
    for req, t in selection:
        want |= {(req, v) for v in full} if t == "all" else {(req, t)}
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["x", "y"])), max_size=10, unique_by=lambda t: t[0]),
       st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["p", "q"])), max_size=10, unique_by=lambda t: t[0]))
def test_union_sets_second_wins(spark, a_rows, b_rows):
    from quartermaster.operators import sets as S
    a = spark.createDataFrame(a_rows or [(99, "x")], "k int, v string")
    b = spark.createDataFrame(b_rows or [(98, "p")], "k int, v string")
    got = {r.k: r.v for r in S.union_sets(a, b, "k").collect()}
    want = dict(a_rows or [(99, "x")])
    want.update(dict(b_rows or [(98, "p")]))
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["view", "purchase", "click"]), st.integers(0, 50)),
                min_size=1, max_size=25))
def test_pair_merge_matches_groups(spark, events):
    df = spark.createDataFrame(events, "user int, kind string, eid int")
    got = {r.user: (r.n_view, r.n_purchase, r.first_view, r.first_purchase)
           for r in J.pair_merge(df, "user", "kind", "view", "purchase", "eid").collect()}
    want = {}
    for u in {e[0] for e in events}:
        v = [e[2] for e in events if e[0] == u and e[1] == "view"]
        p = [e[2] for e in events if e[0] == u and e[1] == "purchase"]
        if v and p:
            want[u] = (len(v), len(p), min(v), min(p))
    assert got == want


@SETTINGS
@given(st.lists(st.lists(st.integers(0, 12), max_size=8), min_size=1, max_size=4))
def test_publish_new_keeps_every_key_once(spark, batches):
    from quartermaster.session import scratch_dir
    from quartermaster.sinks.writers import publish_new
    target = scratch_dir(spark, "prop-k7")
    for i, keys in enumerate(batches):
        if keys:
            publish_new(spark.createDataFrame([(k, i) for k in keys], "k int, batch int"), target, "k")
    got = [r.k for r in spark.read.parquet(target).collect()] if any(batches) else []
    assert sorted(got) == sorted({k for keys in batches for k in keys})
    # the first batch that had a key is the one that published it
    if any(batches):
        first = {}
        for i, keys in enumerate(batches):
            for k in keys:
                first.setdefault(k, i)
        assert {r.k: r.batch for r in spark.read.parquet(target).collect()} == first


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.integers(0, 2), st.integers(0, 5),
                          st.one_of(st.none(), st.floats(-5, 5, allow_nan=False))),
                min_size=1, max_size=20, unique_by=lambda t: (t[0], t[1], t[2])))
def test_resolve_layers_fixed_width_matches_last_wins(spark, settings_rows):
    df = spark.createDataFrame(settings_rows, "key string, layer int, seq long, value double")
    got = {r.key: (r.value, r.winning_layer) for r in A.resolve_layers(df, "key", "layer", "seq", "value").collect()}
    want = {}
    for key in {r[0] for r in settings_rows}:
        best = max((r for r in settings_rows if r[0] == key), key=lambda r: (r[1], r[2]))
        want[key] = (best[3], best[1])
    assert got == want


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 15)), min_size=1, max_size=20),
       st.lists(st.integers(0, 15), max_size=30))
def test_missing_work_matches_sets(spark, required, present):
    req = spark.createDataFrame([(k, i) for i, k in enumerate(required)], "k int, row int")
    have = spark.createDataFrame([(k,) for k in present] or [(99,)], "k int")
    want = sorted(i for i, k in enumerate(required) if k is None or k not in set(present or [99]))
    assert sorted(r.row for r in J.missing_work(req, have, "k").collect()) == want
