from __future__ import annotations

import random
import re

import pytest
import xxhash

from quartermaster.llm import simhash
from quartermaster.llm.common import Scratch
from quartermaster.llm.components import connected_components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(items):
    """items: (doc_id, fp) -> least doc_id reachable."""
    fps = sorted({f for _, f in items})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    best = {}
    for d, f in items:
        if d is not None:
            best[find(f)] = min(best.get(find(f), d), d)
    return {f: best.get(find(f)) for f in fps}


def check(docs):
    got = simhash.components(docs).collect()
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs.select("doc_id", "text").collect()]
    comp = brute_components(rows)
    want = sorted((str(d), f"{f:016x}", str(comp[f])) for d, f in rows)
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want


def texts(n, seed=0):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    base = [" ".join(rnd.choices(words, k=rnd.randint(5, 120))) for _ in range(n // 4)]
    out = list(base)
    while len(out) < n:
        w = rnd.choice(base).split()
        for _ in range(rnd.randint(0, 2)):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        out.append(" ".join(w))
    return out


def test_matches_brute_force(make_docs):
    check(make_docs([(i, t) for i, t in enumerate(texts(200))]))


def test_table_matches_brute_force(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_edge_cases(make_docs, clashes):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, "ÉTÉ été  x y"),
            (None, "one"), (None, "alone here now"), (8, "one"), (8, "one"), (9, "long word " * 50_000)]
    check(make_docs(rows, clashes))
    assert simhash.components(make_docs([])).count() == 0


@pytest.mark.parametrize("block", [2, 4096])
def test_links_connect_like_brute_force(spark, block):
    """Clusters around a centre, with blocks small enough to be cut again."""
    rnd = random.Random(block)
    fps = set()
    for _ in range(6):
        centre = rnd.getrandbits(64)
        for _ in range(60):
            x = centre
            for b in rnd.sample(range(64), rnd.randint(0, 3)):
                x ^= 1 << b
            fps.add(x)
    fps |= {0, 1, 3, 7, 15, (1 << 63), (1 << 64) - 1, (1 << 64) - 8}
    signed = {f - (1 << 64) if f >> 63 else f: f for f in fps}
    scratch = Scratch(spark, "t")
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = simhash.links(df, scratch, block=block)
    pairs = [(signed[r["a"]], signed[r["b"]]) for r in found.collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    roots = {r["node"]: r["root"] for r in connected_components(found, scratch).collect()}
    got = {signed[x]: signed[roots.get(x, x)] for x in signed}
    want = brute_components([(f, f) for f in fps])
    assert {frozenset(f for f in got if got[f] == g) for g in set(got.values())} \
        == {frozenset(f for f in want if want[f] == g) for g in set(want.values())}


def test_components_of_a_long_chain_and_a_star(spark):
    n = 300
    chain = [(i, i + 1) for i in range(n)]
    star = [(10_000, 10_001 + i) for i in range(500)]
    out = connected_components(spark.createDataFrame(chain + star, "a long, b long"), Scratch(spark, "t")).collect()
    assert {(r["node"], r["root"]) for r in out} == \
        {(i, 0) for i in range(1, n + 1)} | {(b, 10_000) for _, b in star}


def test_keep_one_keeps_the_least_of_each_component(make_docs, clashes):
    rows = [(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, "q r s t u"), (7, None), (6, "")]
    docs = make_docs(rows, clashes)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()) == \
        [("3", "a b c d"), ("6", ""), ("None", "q r s t u")]
