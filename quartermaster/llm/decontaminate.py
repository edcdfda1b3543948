"""Benchmark decontamination over a distributed positional inverted index.

1. The index: every task tokenises its documents and stores, per document,
   the posting lists (term, positions) of the terms that the benchmark uses;
   other terms can't take part in a match. The index is partitioned by
   document, like its input, so building and querying it shuffles nothing.
2. Collection frequencies of the terms are summed over the whole index.
3. Each benchmark window (``width`` consecutive words) starts from the
   postings of its rarest term, shifted by the term's offset in the window,
   and is intersected with the equally shifted lists of its other terms, from
   rare to common. What survives is an exact phrase match.
4. A proximity match is a place where at least ``near_share`` of a window's
   terms stand within ``slop`` positions of where they belong, one of them
   exactly there, but not all. Of ``n`` terms ``n - need`` may be missing, so one
   of the ``n - need + 1`` rarest is near: their postings, shifted by up to
   ``slop``, are all the starts there can be. Terms are checked from rare to
   common and a start goes as soon as too many are missing.

Bounds: the benchmark is taken in blocks of about ``block_words`` words
(whole items); only one block at a time is on the driver and broadcast.
A task holds the postings of about ``SLICE_WORDS`` words at once (whole
documents, one at least), candidates come in slices of ``CANDIDATES``, so its
memory follows neither the rows of an Arrow batch nor the length of a partition.
Nothing is dropped or capped.

Defined results: null or word-free texts have no words and no matches; items
without words have no window; an item without an id counts under the empty
name; repeated items count once by id; repeated documents are each reported;
empty tables give no rows, or no matches; texts are read whole, however long;
extra columns travel in a struct or are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_WORD, KEY, Scratch, doc_key, key_id, lower_ascii, slices

WIDTH = 13
SLOP = 2
NEAR_SHARE = 0.8
BLOCK_WORDS = 500_000
CANDIDATES = 250_000
SLICE_WORDS = 250_000
SLICE_BYTES = 8 * SLICE_WORDS  # of text, where words are not counted yet
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # ALNUM_WORD on lower-cased UTF-8
MARGIN = 1 << 20  # starts may lie before the first word
SHIFT = 40  # a posting is term << SHIFT | position


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


# ---------------------------------------------------------------- benchmark

class Phrases:
    """Windows of one benchmark block: term ids (rare to common once
    :meth:`order` has run), their offsets and the item each belongs to."""

    def __init__(self, items: list[tuple[str, list[bytes]]], width: int):
        self.vocab: dict[bytes, int] = {}
        names: dict[str, int] = {}
        rows, owner = [], []
        for name, words in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            item = names.setdefault(name, len(names))
            n = min(width, len(ids))
            for i in range(len(ids) - n + 1 if n else 0):
                rows.append(ids[i:i + n] + [-1] * (width - n))
                owner.append(item)
        self.names = list(names)
        self.width = width
        self.terms = np.array(rows, np.int64).reshape(-1, width)
        self.length = (self.terms >= 0).sum(axis=1)
        self.owner = np.array(owner, np.int64)

    def order(self, freq: np.ndarray) -> None:
        """Sorts each window's terms from rare to common; padding goes last."""
        cost = np.where(self.terms >= 0, freq[self.terms], np.iinfo(np.int64).max)
        self.offset = np.argsort(cost, axis=1, kind="stable")
        self.terms = np.take_along_axis(self.terms, self.offset, axis=1)
        by_anchor = np.argsort(self.terms[:, 0], kind="stable")
        for k in ("terms", "offset", "length", "owner"):
            setattr(self, k, getattr(self, k)[by_anchor])


# -------------------------------------------------------------------- index

def _text_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(3)), 0).to_numpy(zero_copy_only=False)
        yield from slices(batch, sizes, SLICE_BYTES)


def _postings(vocab):
    """Task side of the index build."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = vocab.value.get
        for batch in _text_slices(batches):
            n_words, terms, freqs, places = [], [], [], []
            for text in batch.column(3).to_pylist():
                words = words_of(text)
                ids = np.array([find(w, -1) for w in words], np.int64)
                at = np.flatnonzero(ids >= 0)
                at = at[np.argsort(ids[at], kind="stable")]
                term, freq = np.unique(ids[at], return_counts=True)
                n_words.append(len(words))
                terms.append(term.astype(np.int32))
                freqs.append(freq.astype(np.int32))
                places.append(at.astype(np.int32))
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(n_words, pa.int64()), pa.array(terms, kind),
                 pa.array(freqs, kind), pa.array(places, kind)],
                names=[*KEY, "n_words", "terms", "freqs", "places"])

    return run


def build_index(docs: DataFrame, vocab, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its posting lists for the terms of ``vocab``."""
    rows = docs.select(*doc_key(doc_id, text), F.col(text).cast("binary").alias("body"))
    return rows.mapInArrow(_postings(vocab), "k_id long, k_null boolean, k_hash long, n_words long, "
                           "terms array<int>, freqs array<int>, places array<int>")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(zero_copy_only=False), \
        column.value_lengths().to_numpy(zero_copy_only=False)


def _candidates(keys: np.ndarray, windows: Phrases, rank: int, slop: int):
    """(window, start) of every posting of every window's term of ``rank`` (0:
    rarest), shifted by up to ``slop``, in slices of about CANDIDATES rows."""
    term = windows.terms[:, rank]
    lo = np.searchsorted(keys, term << SHIFT)
    n = np.where(term >= 0, np.searchsorted(keys, (term + 1) << SHIFT) - lo, 0)
    used = np.flatnonzero(n)
    piece = np.cumsum(n[used]) * (2 * slop + 1) // CANDIDATES
    for k in np.unique(piece):
        w = used[piece == k]
        win = np.repeat(w, n[w])
        within = np.arange(len(win)) - np.repeat(np.cumsum(n[w]) - n[w], n[w])
        start = (keys[lo[win] + within] & ((1 << SHIFT) - 1)) - windows.offset[win, rank]
        yield np.repeat(win, 2 * slop + 1), (start[:, None] + np.arange(-slop, slop + 1)).ravel()


def _stands(keys: np.ndarray, want: np.ndarray, slop: int) -> np.ndarray:
    """Whether a posting lies within ``slop`` of each wanted one."""
    at = np.minimum(np.searchsorted(keys, want - slop), len(keys) - 1)
    return np.abs(keys[at] - want) <= slop


def _match(keys: np.ndarray, windows: Phrases, slop: int, near_share: float):
    """Exact and proximity matches as (window, start) arrays."""
    exact, near = [], []
    for win, start in _candidates(keys, windows, 0, 0):
        for j in range(1, windows.width):
            term = windows.terms[win, j]
            ok = (term < 0) | _stands(keys, (term << SHIFT) + start + windows.offset[win, j], 0)
            win, start = win[ok], start[ok]
        exact.append((win, start))
    need = np.ceil(near_share * windows.length).astype(np.int64)
    may_miss = windows.length - need
    for rank in range(int(may_miss.max(initial=-1)) + 1):
        for win, start in _candidates(keys, windows, rank, slop):
            ok = rank <= may_miss[win]
            packed = np.unique((win[ok] << SHIFT) + start[ok] + MARGIN)
            win, start = packed >> SHIFT, (packed & ((1 << SHIFT) - 1)) - MARGIN
            missing, off = np.zeros(len(win), np.int64), np.zeros(len(win), np.int64)
            for j in range(windows.width):
                term = windows.terms[win, j]
                want = np.where(term >= 0, (term << SHIFT) + start + windows.offset[win, j], -1 << SHIFT)
                missing += (term >= 0) & ~_stands(keys, want, slop)
                off += (term >= 0) & ~_stands(keys, want, 0)
                ok = missing <= may_miss[win]
                win, start, missing, off = win[ok], start[ok], missing[ok], off[ok]
            ok = (off > 0) & (off < windows.length[win])
            near.append((win[ok], start[ok]))
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    joined = [tuple(np.concatenate(x) for x in zip(*part)) if part else empty for part in (exact, near)]
    return joined[0], joined[1]


def _lists(docs: np.ndarray, items: np.ndarray, names: list[str], n_docs: int) -> pa.Array:
    """Distinct item names per document."""
    out: list[list[str]] = [[] for _ in range(n_docs)]
    for d, i in np.unique(np.stack([docs, items], axis=1), axis=0) if len(docs) else ():
        out[d].append(names[i])
    return pa.array(out, pa.list_(pa.string()))


def _query(shared, slop: int, near_share: float):
    """Task side of the matching: spans of hit words and matched items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        gap = windows.width + 3 * slop + 1  # no candidate reaches another document
        for batch in (x for b in batches for x in slices(b, b.column(3).to_numpy(), SLICE_WORDS)):
            n_docs = batch.num_rows
            n_words = batch.column(3).to_numpy()
            base = gap + np.concatenate([[0], np.cumsum(n_words + gap)])
            terms, n_terms = _flat(batch.column(4))
            freqs, _ = _flat(batch.column(5))
            places, n_places = _flat(batch.column(6))
            keys = np.sort((np.repeat(terms.astype(np.int64), freqs) << SHIFT)
                           + places + np.repeat(base[:-1], n_places))
            cover = np.zeros(base[-1] + 1, np.int32)
            (win, start), (near_win, near_start) = _match(keys, windows, slop, near_share) \
                if len(keys) else ((np.zeros(0, np.int64),) * 2,) * 2
            np.add.at(cover, start, 1)
            np.add.at(cover, start + windows.length[win], -1)
            edges = np.diff(np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8), [0]]))
            lo, hi = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            of = np.searchsorted(base, lo, side="right") - 1
            spans: list[list[dict]] = [[] for _ in range(n_docs)]
            for d, a, b in zip(of.tolist(), (lo - base[of]).tolist(), (hi - base[of]).tolist()):
                spans[d].append({"start": a, "end": b})
            in_doc = lambda s: np.clip(np.searchsorted(base, s, side="right") - 1, 0, n_docs - 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 _lists(in_doc(start), windows.owner[win], windows.names, n_docs),
                 _lists(in_doc(near_start + windows.width + slop), windows.owner[near_win], windows.names, n_docs)],
                names=[*KEY, "n_words", "spans", "items", "near_items"])

    return run


MATCHED = ("k_id long, k_null boolean, k_hash long, n_words long, "
           "spans array<struct<start:bigint,end:bigint>>, items array<string>, near_items array<string>")


def _merge_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unites the spans that several benchmark blocks found in a document."""
    for batch in batches:
        merged = []
        for spans in batch.column(4).to_pylist():
            out: list[dict] = []
            for s in sorted(spans, key=lambda x: (x["start"], x["end"])):
                if out and s["start"] <= out[-1]["end"]:
                    out[-1]["end"] = max(out[-1]["end"], s["end"])
                else:
                    out.append(dict(s))
            merged.append(out)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(merged, batch.schema.field(4).type), *batch.columns[5:]],
            names=batch.schema.names)


def phrase_matches(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, doc_id: str = "doc_id",
                   text: str = "text", item_id: str = "item_id", item_text: str = "text",
                   width: int = WIDTH, slop: int = SLOP, near_share: float = NEAR_SHARE,
                   block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(k_id, k_null, k_hash, n_words, spans, items, near_items)`` per
    document: spans of words inside exact matches, ids of the items with an
    exact match and with a proximity match only or as well."""
    sc = docs.sparkSession.sparkContext
    items = scratch.table(benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"),
                                           F.col(item_text).alias("body")), "items")
    n_words = items.agg(F.sum(F.regexp_count(lower_ascii(F.col("body")), F.lit(ALNUM_WORD)))).first()[0] or 0
    n_blocks = max(1, math.ceil(n_words / block_words))
    parts = []
    for k in range(n_blocks):
        mine = items.where(F.pmod(F.xxhash64("name", "body"), F.lit(n_blocks)) == k)
        phrases = Phrases([(r["name"], words_of((r["body"] or "").encode())) for r in
                           mine.orderBy("name", "body").toLocalIterator()], width)
        index = scratch.table(build_index(docs, sc.broadcast(phrases.vocab), doc_id, text), f"index-{k}")
        freq = np.zeros(len(phrases.vocab) + 1, np.int64)
        for r in (index.select(F.inline(F.arrays_zip("terms", "freqs"))).groupBy("terms")
                  .agg(F.sum("freqs").alias("n")).toLocalIterator()):
            freq[r["terms"]] = r["n"]
        phrases.order(freq)
        parts.append(index.mapInArrow(_query(sc.broadcast(phrases), slop, near_share), MATCHED))
    if n_blocks == 1:
        return parts[0]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    # Repeated documents (equal key) have equal rows in each block.
    flat = lambda c: F.array_distinct(F.flatten(F.collect_set(c)))
    times = union.groupBy(*KEY, "n_words").agg(
        F.count(F.lit(1)).alias("times"), F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans"),
        flat("items").alias("items"), flat("near_items").alias("near_items"))
    return (times.withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("times") / n_blocks).cast("int"))))
            .select(*KEY, "n_words", "spans", "items", "near_items").mapInArrow(_merge_spans, MATCHED))


def contamination(matched: DataFrame) -> DataFrame:
    """Adds the document counts and the contract's contamination rule."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return (matched.withColumn("n_hit", hit)
            .withColumn("n_items", F.size("items").cast("long"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  **params) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    found = contamination(phrase_matches(docs, benchmark, scratch, doc_id, text, **params))
    bad = scratch.result(found.where("contaminated").select(*[F.col(c).alias(f"bad_{c}") for c in KEY]).distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *doc_key(doc_id, text))
    return rows.join(bad, [F.col(c) == F.col(f"bad_{c}") for c in KEY], "left_anti").select("row.*")


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
           **params) -> DataFrame:
    """One row per document with hit counts, digest of the items found and
    the verdict, plus the number of items with a proximity match."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    found = contamination(phrase_matches(docs, benchmark, scratch, doc_id, text, **params))
    return scratch.result(found.select(
        key_id().alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        "contaminated", F.size("near_items").cast("long").alias("n_near_items")))
