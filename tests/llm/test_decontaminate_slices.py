"""A task's memory follows SLICE_WORDS, not the rows of an Arrow batch."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from quartermaster.llm import decontaminate as D


class Held:
    def __init__(self, value):
        self.value = value


def batch_of(texts):
    n = len(texts)
    return pa.record_batch([pa.array(range(n), pa.int64()), pa.array([False] * n), pa.array([0] * n, pa.int64()),
                            pa.array(texts, pa.binary())], names=[*D.KEY, "body"])


def found(phrases, texts):
    index = list(D._postings(Held(phrases.vocab))(iter([batch_of(texts)])))
    out = list(D._query(Held(phrases), D.SLOP, D.NEAR_SHARE)(iter([pa.Table.from_batches(index).combine_chunks().to_batches()[0]])))
    return [r for b in out for r in b.to_pylist()]


def phrases_of(items):
    phrases = D.Phrases(items, D.WIDTH)
    phrases.order(np.zeros(len(phrases.vocab) + 1, np.int64))
    return phrases


def test_slices_change_no_result(monkeypatch):
    rng = random.Random(3)
    vocab = [b"a%d" % k for k in range(30)]
    phrases = phrases_of([(str(k), rng.choices(vocab, k=rng.choice([2, 5, 13, 20]))) for k in range(20)])
    texts = [b" ".join(rng.choices(vocab, k=rng.choice([0, 1, 40, 300]))) for _ in range(120)] + [None, b""]
    want = found(phrases, texts)
    for words, candidates in ((1, 7), (500, 100)):
        monkeypatch.setattr(D, "SLICE_WORDS", words)
        monkeypatch.setattr(D, "SLICE_BYTES", 8 * words)
        monkeypatch.setattr(D, "CANDIDATES", candidates)
        assert found(phrases, texts) == want
    assert any(r["items"] for r in want) and any(r["near_items"] for r in want)


def test_memory_does_not_grow_with_the_batch():
    words = [b"w%d" % k for k in range(50)]
    phrases = phrases_of([("1", words)])
    text = b" ".join(words * 40)  # 2,000 words

    def peak(n_docs):
        batch = pa.Table.from_batches(list(D._postings(Held(phrases.vocab))(iter([batch_of([text] * n_docs)])))).combine_chunks()
        tracemalloc.start()
        for _ in D._query(Held(phrases), D.SLOP, D.NEAR_SHARE)(iter([batch.to_batches()[0]])):
            pass
        return tracemalloc.get_traced_memory()[1], tracemalloc.stop()

    assert peak(2000)[0] < 1.5 * peak(250)[0]
