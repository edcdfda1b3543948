"""MinHash near-dedup on SetSketch registers against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
from helpers import SF01

from quartermaster.llm import setsketch


def plain_sets(docs):
    out = []
    for d, text in docs:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for c in "\t\n\x0b\x0c\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        out.append({tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set())
    return out


def plain(docs, threshold=80):
    """(doc_id, n_shingles, component_id, kept) by an inverted index over all
    shingles and union-find."""
    sets = plain_sets(docs)
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    index = {}
    for k, s in enumerate(sets):
        shared = {}
        for g in s:
            for j in index.get(g, ()):
                shared[j] = shared.get(j, 0) + 1
            index.setdefault(g, []).append(k)
        for j, n in shared.items():
            if 100 * n >= threshold * (len(s) + len(sets[j]) - n):
                root[find(k)] = find(j)
    least = {}
    for k, (d, _) in enumerate(docs):
        if d is not None:
            r = find(k)
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(sets[k]), least.get(find(k)), d == least.get(find(k)))
                   for k, (d, _) in enumerate(docs)), key=repr)


def result(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_table_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    want = plain([tuple(r) for r in docs.collect()])
    assert sum(not r[3] for r in want) > 20
    assert result(setsketch.near_dedup(docs)) == want


def _family(n, words=100, seed=1):
    """Texts that differ from one text in a varying number of words."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for k in range(n):
        w = list(base)
        for at in rng.integers(0, words, rng.integers(0, 9)):
            w[at] = f"x{k}_{at}"
        out.append((k * 3 + 1, " ".join(w)))
    return out


def test_large_groups_in_blocks_lose_no_link(make_docs, monkeypatch):
    docs = _family(120) + [(1000 + k, t) for k, (_, t) in enumerate(_family(40, seed=2))]
    want = plain(docs)
    assert len({r[2] for r in want}) > 20
    df = make_docs(docs).select("doc_id", "text").repartition(5)
    assert result(setsketch.near_dedup(df)) == want
    monkeypatch.setattr(setsketch, "BUCKET", 8)          # buckets in blocks
    monkeypatch.setattr(setsketch, "SAME", 3)
    monkeypatch.setattr(setsketch, "CLUSTER_BYTES", 8000)  # clusters in blocks
    assert result(setsketch.near_dedup(df)) == want


def test_exactly_eighty_per_cent_is_linked(make_docs):
    # 40 shingles each: 4 more at the end make 40 of 44, 8 make 40 of 48 (linked), 11 make 40 of 51 (not).
    words = [f"w{i}" for i in range(43)]
    rows = [(1, " ".join(words)), (2, " ".join(words + [f"y{i}" for i in range(10)])),
            (3, " ".join(f"q{i}" for i in range(43))), (4, " ".join([f"q{i}" for i in range(43)] + [f"y{i}" for i in range(11)]))]
    got = {r[0]: r[2] for r in result(setsketch.near_dedup(make_docs(rows)))}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_edge_cases(make_docs, clashes):
    long = " ".join(f"v{i}" for i in range(60_000))
    rows = [(None, None), (None, "Only null ids here, twice over"), (None, "only NULL ids here, twice over"), (1, None),
            (2, ""), (3, " \t\n\x0b"), (4, "a b"), (5, "A\tB"), (6, "a b c"), (7, long), (8, long + " tail"), (9, long),
            (9, long), (10, "a b"), (None, "a b"), (11, "  É"), (12, "  é")]
    docs = make_docs(rows, clashes)
    got = result(setsketch.near_dedup(docs))
    want = []
    for r in plain(rows):
        # A null id is kept where no id names the component.
        want.append(r if r[0] is not None else (*r[:3], r[2] is None))
    assert got == sorted(want, key=repr)
    assert setsketch.near_dedup(docs.where("false")).count() == 0


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(3)
    items = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2)
    a, b = items[:3000], items[500:]
    assert (setsketch.merge(setsketch.sketch(a), setsketch.sketch(b)) == setsketch.sketch(items)).all()
    errors = []
    for k in range(60):
        items = rng.integers(0, 1 << 63, 1200, dtype=np.uint64)
        lo = int(rng.integers(50, 200))
        a, b = items[:1000], items[lo:lo + 1000]
        x, y = setsketch.sketch(a), setsketch.sketch(b)
        j, error = setsketch.estimate(np.array([(x > y).sum()]), np.array([(x < y).sum()]), 1000.0, np.array([1000.0]))
        errors.append((j[0] - (1000 - lo) / (1000 + lo)) / error[0])
    assert abs(np.mean(errors)) < 0.6 and 0.6 < np.std(errors) < 1.5


@pytest.mark.parametrize("threshold", [80, 95])
def test_threshold(make_docs, threshold):
    rows = _family(50, words=60, seed=7)
    docs = make_docs(rows).select("doc_id", "text")
    assert result(setsketch.near_dedup(docs, threshold=threshold)) == plain(rows, threshold)


def test_lower_thresholds_are_refused(make_docs):
    with pytest.raises(ValueError, match="80"):
        setsketch.near_dedup(make_docs([(1, "a")]), threshold=60)
