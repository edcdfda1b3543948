from __future__ import annotations

from collections import Counter

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartermaster.llm import mixing


def brute_targets(sizes):
    """Reshare the excess by weight until no target is above its ceiling."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, out, free = 1.5 * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    left = total
    while free and left > 1e-9:
        w = sum(weight[s] for s in free)
        for s in free:
            out[s] += left * weight[s] / w
        left = 0.0
        for s in list(free):
            if out[s] >= 2 * sizes[s]:
                left += out[s] - 2 * sizes[s]
                out[s] = 2.0 * sizes[s]
                free.remove(s)
    return out


def check(out, longest):
    rows = out.collect()
    sizes, taken, target = {}, {}, {}
    for r in rows:
        assert r["copies"] in (0, 1, 2) and r["taken"] == r["copies"] * r["size"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    assert {r["source"]: r["source_size"] for r in rows} == sizes
    want = brute_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= longest + 1e-6
    return rows


def docs_of(make_docs, n, sources, seed=1):
    rnd = random.Random(seed)
    return make_docs([(i, "w " * int(rnd.paretovariate(1) * 3 % 500), "en",
                       rnd.choice(sources) if rnd.random() < 0.6 else sources[0]) for i in range(n)])


@pytest.mark.parametrize("bucket_rows,fan_in", [(16_384, 64), (50, 2), (7, 3)])
def test_sources_come_within_one_document_of_their_target(make_docs, bucket_rows, fan_in):
    docs = docs_of(make_docs, 1500, ["b", "a", None, "z", "é"])
    check(mixing.mix(docs, bucket_rows=bucket_rows, fan_in=fan_in), 500)


def test_reruns_agree_whatever_the_layout(make_docs):
    docs = docs_of(make_docs, 600, ["a", "b", "c"])
    def run(d):
        return sorted((r["id"], r["copies"]) for r in
                      mixing.mix(d, bucket_rows=64, fan_in=2).select(F.col("row.doc_id").alias("id"), "copies").collect())
    assert run(docs) == run(docs.repartition(7)) == run(docs.orderBy(F.desc("doc_id")))


def test_edge_cases(make_docs, clashes):
    assert mixing.mix(make_docs([])).count() == 0
    rows = [(1, None, "en", "a"), (2, "", "en", None), (None, "x y", "en", None), (3, "x", "en", "a"),
            (3, "x", "en", "a"), (4, "w " * 300_000, "en", "big"), (5, "u v", "en", "big")]
    out = mixing.mix(make_docs(rows, clashes))
    assert out.count() == len(rows)
    check(out, 300_000)


def test_one_id_for_all_rows(make_docs):
    # Equal rows by the hundred, and every id null: targets are met and layouts agree.
    rows = [(None, "same words in every row", "en", f"s{k % 3}") for k in range(600)]
    rows += [(None, f"own words {k} " * (1 + k % 5), "en", f"s{k % 4}") for k in range(600)]
    out = []
    for parts in (1, 7):
        docs = make_docs(rows).repartition(parts)
        got = mixing.mix(docs, bucket_rows=64, fan_in=4)
        out.append(sorted((r["row"]["text"], r["source"], r["copies"]) for r in got.collect()))
        taken, target = Counter(), {}
        for r in got.collect():
            taken[r["source"]] += r["taken"]
            target[r["source"]] = r["target"]
        assert all(abs(taken[s] - target[s]) <= 15 for s in target)
    assert out[0] == out[1]


def test_pivotal_keeps_expectation_and_total():
    size = np.array([5.0, 9.0, 2.0, 7.0, 7.0, 1.0, 30.0])
    p = np.array([0.3, 0.8, 0.5, 0.1, 0.9, 0.5, 0.4])
    rnd = np.random.default_rng(0)
    got = np.array([mixing.pivotal(np.zeros(7, int), size, size * p,
                                   rnd.integers(0, 1 << 63, 7).astype(np.uint64)) for _ in range(4000)])
    assert np.allclose(got.sum(axis=1), (size * p).sum())
    assert (((got > 1e-9) & (got < size - 1e-9)).sum(axis=1) <= 1).all()
    assert np.allclose((got / size).mean(axis=0), p, atol=0.04)
