"""Spelling variants against a plain version by wildcard neighbours."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from helpers import SF01, SF001

from quartermaster.llm import spelling
from quartermaster.llm.common import Scratch


def plain_counts(docs, noise=97, min_count=3):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise and h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= min_count}


def plain(docs, noise=97):
    n = plain_counts(docs, noise)
    near = defaultdict(set)
    meet = defaultdict(set)
    for w in n:
        for k in range(len(w)):
            meet[w[:k] + "*" + w[k + 1:]].add(w)  # replaced
            short = w[:k] + w[k + 1:]
            if short in n:                        # inserted or deleted
                near[w].add(short)
                near[short].add(w)
    for words in meet.values():
        for w in words:
            near[w] |= words - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


COLS = ["word", "form", "root", "n", "n_near", "form_n"]


def result(df):
    assert df.columns == COLS
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_tables_equal_plain_version(spark):
    for folder in (SF001, SF01):
        docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
        want = plain([tuple(r) for r in docs.collect()])
        assert sum(r[1] is not None for r in want) > 50 and max(r[4] for r in want) > 5
        assert result(spelling.variants(docs, noise=97)) == want


def _random_words(seed, n, letters="abcéÿ"):
    rng = random.Random(seed)
    return ["".join(rng.choices(letters, k=rng.randint(5, 8))) for _ in range(n)]


def test_blocks_in_chunks_lose_no_pair(make_docs, monkeypatch):
    words = _random_words(1, 1500)
    docs = [(k, " ".join(words[k::30] * (3 + k % 5))) for k in range(30)]
    want = plain(docs)
    df = make_docs(docs).select("doc_id", "text").repartition(6)
    assert result(spelling.variants(df, noise=97)) == want
    monkeypatch.setattr(spelling, "HOME", 8)
    monkeypatch.setattr(spelling, "SLAB", 3)
    assert result(spelling.variants(df, noise=97)) == want
    monkeypatch.setattr(spelling, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(spelling, "FULL", 1)  # neighbours that share a block number
    assert result(spelling.variants(df, noise=97)) == want


def test_one_edit():
    words = sorted(set(_random_words(2, 300, "ab")))
    a = spelling._Words(words, np.ones(len(words), np.int64))
    x, y = np.nonzero(np.ones((len(words), len(words))))
    got = spelling.one_edit(a.spell(x, 9), a.spell(y, 9), a.lengths[x], a.lengths[y])

    def edits(w):
        return {w[:k] + w[k + 1:] for k in range(len(w))}

    def plain_edit(p, q):
        if len(p) == len(q):
            return sum(c != d for c, d in zip(p, q)) == 1
        return q in edits(p) or p in edits(q)

    assert got.tolist() == [plain_edit(words[i], words[j]) for i, j in zip(x, y)]


def test_roots_follow_chains(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(11)] + [("x", "w3"), ("y", "z")]
    scratch = Scratch(spark, "t")
    got = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(chain, "word string, form string"), scratch).collect()}
    assert got == {**{f"w{k}": "w11" for k in range(11)}, "x": "w11", "y": "z"}
    scratch.drop()


def test_edge_cases(make_docs, clashes):
    long = "ab" * 1_500
    docs = [(None, None), (None, "Straße straße STRAßE strase strase strase"), (1, ""), (2, "12 _ 3"),
            (3, f"{long} {long} {long} {long}c {long}c {long}c"), (4, "colour " * 9 + "color " * 4 + "colours " * 3),
            (4, "colour " * 9), (5, "ÀÀÀÀÀ ààààà " * 3 + "a b c d\n"), (6, None)]
    df = make_docs(docs, clashes)
    for noise in (97, None, 2):
        assert result(spelling.variants(df, noise=noise)) == plain(docs, noise)
    assert spelling.variants(df.where("false")).count() == 0
