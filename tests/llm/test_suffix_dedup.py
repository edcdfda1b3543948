from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from quartermaster.llm import suffix_dedup


def brute(rows, length):
    """(n_bytes, n_removed, n_spans, kept) of each text."""
    seen = Counter()
    for t in rows:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] += 1
    out = []
    for t in rows:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append((len(t), int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()),
                    hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


def check(docs, length, **params):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.select("doc_id", "text").collect()]
    want = sorted((str(d), *x) for (d, _), x in zip(rows, brute([t for _, t in rows], length)))
    got = suffix_dedup.report(docs, length=length, **params).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want


def random_texts(n, seed, alphabet="abé \n"):
    rnd = random.Random(seed)
    passage = "".join(rnd.choices(alphabet, k=120))
    texts = []
    for _ in range(n):
        t = "".join(rnd.choices(alphabet, k=rnd.randint(0, 150)))
        if rnd.random() < 0.5:
            lo = rnd.randrange(60)
            t += passage[lo:lo + rnd.randint(10, 60)] + "".join(rnd.choices(alphabet, k=20))
        texts.append(rnd.choice(texts) if texts and rnd.random() < 0.2 else t)
    return texts


@pytest.mark.parametrize("block_bytes", [1 << 19, 60])
def test_matches_brute_force(make_docs, block_bytes):
    """The small block makes shared anchors hot and the blocks many."""
    docs = make_docs([(i, t) for i, t in enumerate(random_texts(150, block_bytes))])
    check(docs, 24, gram=8, block_bytes=block_bytes)


def test_table_matches_brute_force(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), 200)


def test_edge_cases(make_docs, clashes):
    rows = [(1, None), (2, ""), (3, "x" * 199), (4, "y" * 201), (5, "z" * 200), (5, "z" * 200), (None, "ab" * 300),
            (6, "\x00" * 210 + "é" * 120), (7, "a" * 150 + "b" * 150), (8, "q" + "b" * 150 + "a" * 150)]
    check(make_docs(rows, clashes), 200)
    assert suffix_dedup.report(make_docs([])).count() == 0


def test_a_text_longer_than_a_slice(make_docs, monkeypatch):
    rnd = random.Random(5)
    text = "".join(rnd.choices("abcd ", k=5000))
    pieces = suffix_dedup._cut_long
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    _, start, size, _ = pieces(text.encode(), 50, 8)
    covered = sorted(s + i for s, n in zip(start, size) for i in range(n - 49))
    assert covered == list(range(5000 - 49))


def test_suffix_array_orders_suffixes():
    rnd = random.Random(3)
    for _ in range(30):
        s = [rnd.randint(0, 3) for _ in range(rnd.randint(1, 60))] + [0]
        sa = suffix_dedup.suffix_array(np.array(s, np.uint8), 64).tolist()
        assert sa == sorted(range(len(s)), key=lambda i: s[i:])
