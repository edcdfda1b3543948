"""Exact substring dedup with suffix arrays, two-stage sorting.

Removes every byte that lies in a string of ``length`` bytes that also
starts somewhere else.

1. Every window of ``length`` bytes is owned by the smallest hash among its
   ``GRAM``-byte strings (its anchor). Neighbouring windows share anchors, so
   a document is cut into overlapping pieces, one per run of windows with
   one anchor. Equal windows have equal anchors, so they meet under one key
   and nowhere else. Only keys travel, about one per 90 bytes.
2. Keys that occur once are done: none of their windows repeats. Pieces
   whose whole content occurs twice are done as well: all their windows do.
   What is left are pieces that share an anchor but differ, as at the edges
   of a repeated passage; one piece of each content is fetched.
3. Fetched pieces are dealt into blocks of about ``block_bytes`` by anchor.
   A block's suffix array is built by two-stage sorting: suffixes smaller
   than their successor are sorted directly, the others are induced from
   them by one scan over the buckets. Adjacent common prefixes of at least
   ``length`` bytes are the repeated windows.
4. An anchor whose pieces alone exceed a block is not put into one task: its
   windows are counted by digest instead (partial counts in every task), so
   the result is the same at any size.

Counts are aggregated before they are shuffled, so copies by the thousand
are one row per task. Documents are identified by (doc_id, hash of the text).

Defined results: null is an empty text; texts shorter than ``length`` are
kept whole; repeated rows are copies of each other; a text is taken whole
however long.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, Scratch, doc_key, key_id

LENGTH = 200
GRAM = 64
BLOCK_BYTES = 1 << 19
HOT_BLOCKS = 4  # an anchor with more than so many blocks of pieces is hot
CHUNK = 1 << 21  # bytes handled at once in step 1
BASE = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------- step 1: cut

def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Polynomial hash of the ``gram`` bytes (a power of two) from each
    position, by doubling, then mixed."""
    h, have, power = data.astype(np.uint64) + np.uint64(1), 1, BASE
    while have < gram:
        h = h[:len(h) - have] * power + h[have:]
        with np.errstate(over="ignore"):
            power = power * power
        have *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def cut(texts: list[bytes], length: int, gram: int):
    """Pieces of several texts: arrays (text, start, size, anchor hash)."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, np.uint64),)
    hashes = _gram_hashes(data, gram)
    low = np.uint64((1 << 24) - 1)
    ranked = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)  # ties: leftmost
    best = (_window_min(ranked, length - gram + 1) & low).astype(np.int64)
    window = np.arange(len(best))
    text = np.searchsorted(ends, window, side="right")
    ok = window + length <= ends[np.minimum(text, len(ends) - 1)]
    new = ok.copy()
    new[1:] &= (best[1:] != best[:-1]) | (text[1:] != text[:-1]) | ~ok[:-1]
    first = np.flatnonzero(new)
    # A run ends before the next run or the next window that crosses texts.
    stop = np.flatnonzero(ok & np.append(new[1:] | ~ok[1:], True))
    begin = np.concatenate([[0], ends[:-1]])
    return text[first], first - begin[text[first]], stop - first + length, hashes[best[first]]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _pieces(length: int, gram: int):
    """Rows (anchor, content, size, key..., start) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = batch.column(3).to_pylist()
            lo = 0
            while lo < len(body):
                hi, room = lo, CHUNK
                while hi < len(body) and (hi == lo or len(body[hi]) <= room):
                    room -= len(body[hi])
                    hi += 1
                texts = body[lo:hi]
                if sum(map(len, texts)) < 1 << 24:
                    text, start, size, anchor = cut(texts, length, gram)
                else:  # one very long text: slices that overlap by a window
                    text, start, size, anchor = _cut_long(texts[0], length, gram)
                content = np.array([xxhash.xxh3_64_intdigest(texts[t][s:s + n]) for t, s, n in
                                    zip(text.tolist(), start.tolist(), size.tolist())], np.uint64)
                rows = pa.array(text + lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(anchor)), pa.array(_signed(content)), pa.array(size.astype(np.int32)),
                     *[batch.column(k).take(rows) for k in range(3)], pa.array(start.astype(np.int64))],
                    names=["anchor", "content", "size", *KEY, "start"])
                lo = hi

    return run


def _cut_long(text: bytes, length: int, gram: int):
    """``cut`` for one text, slice by slice. A slice edge may split a run in
    two pieces of one anchor; their windows still meet their equals."""
    parts = []
    for at in range(0, len(text) - length + 1, CHUNK):
        _, start, size, anchor = cut([text[at:at + CHUNK + length - 1]], length, gram)
        parts.append((np.zeros(len(start), np.int64), start + at, size, anchor))
    return tuple(np.concatenate(x) for x in zip(*parts))


# ------------------------------------------------- step 3: suffix arrays

def _words(codes: np.ndarray, more: int) -> np.ndarray:
    """The eight codes from each position as one number, and ``more`` zeros."""
    padded = np.concatenate([codes, np.zeros(more + 8, np.uint8)]).astype(np.uint64)
    word = np.zeros(len(codes) + more, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | padded[k:k + len(word)]
    return word


def _direct_sort(codes: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ``at`` by their first ``depth`` codes: by the first sixteen in
    arrays, and runs that are equal so far by what follows."""
    word, raw = _words(codes, 8), codes.tobytes()
    order = at[np.lexsort((word[at + 8], word[at]))]
    equal = (word[order[1:]] == word[order[:-1]]) & (word[order[1:] + 8] == word[order[:-1] + 8])
    cuts = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
    for lo, hi in zip(cuts[::2].tolist(), (cuts[1::2] + 1).tolist()):
        order[lo:hi] = sorted(order[lo:hi].tolist(), key=lambda i: raw[i + 16:i + depth])
    return order


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``codes`` (bytes plus one, which UTF-8 leaves room for;
    0: end of a piece) in order of their first ``depth`` codes at least, by
    two-stage sorting.

    Type B suffixes (not greater than their successor) are sorted directly;
    a type A suffix is greater than its successor, so one scan from the small
    buckets to the large ones meets the successor first and puts it next into
    its bucket."""
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.int64)
    follow = np.append(codes[1:].astype(np.int16), -1)
    differs = np.flatnonzero(codes != follow)
    type_a = (codes > follow)[differs[np.searchsorted(differs, np.arange(n))]]
    direct = _direct_sort(codes, np.flatnonzero(~type_a), depth)
    run_start = np.maximum.accumulate(np.where(np.append(True, codes[1:] != codes[:-1]), np.arange(n), 0))
    cut_b = np.searchsorted(codes[direct], np.arange(257))
    # Type A suffixes of each bucket in the order in which they are met.
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if type_a[n - 1]:  # the last suffix has no successor to be met
        waiting[codes[n - 1]].append(np.array([n - 1]))
    out = []
    for code in range(256):
        met = np.concatenate([*waiting[code], np.zeros(0, np.int64)])
        # In front of a met suffix, its code may repeat: those come next, the nearest of every run first.
        steps = met - run_start[met]
        of = np.repeat(np.arange(len(met)), steps)
        step = np.arange(len(of)) - np.repeat(np.cumsum(steps) - steps, steps) + 1
        order = np.argsort(step, kind="stable")
        whole = np.concatenate([met, met[of[order]] - step[order], direct[cut_b[code]:cut_b[code + 1]]])
        out.append(whole)
        before = whole[whole > 0] - 1
        before = before[type_a[before] & (codes[before] > code)]
        if len(before):
            before = before[np.argsort(codes[before], kind="stable")]
            cuts = np.searchsorted(codes[before], np.arange(257))
            for to in np.unique(codes[before]).tolist():
                waiting[to].append(before[cuts[to]:cuts[to + 1]])
    return np.concatenate(out)


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """Per piece, the starts of its windows that some other window equals."""
    codes = np.frombuffer(b"\xff".join([*pieces, b""]), np.uint8) + np.uint8(1)  # 0xff, never in UTF-8, ends a piece
    sizes = np.array([len(p) + 1 for p in pieces])
    ends = np.cumsum(sizes) - 1
    sa = suffix_array(codes, length)
    piece = np.repeat(np.arange(len(pieces)), sizes)
    sa = sa[ends[piece[sa]] - sa >= length]  # suffixes that hold a window
    # Common prefixes of neighbours, eight codes at a time, cut at ``length``.
    word = _words(codes, length)
    same = np.arange(len(sa) - 1) if len(sa) > 1 else np.zeros(0, np.int64)
    for at in [*range(0, length - 7, 8), length - 8]:
        same = same[word[sa[same] + at] == word[sa[same + 1] + at]]
    hit = np.unique(np.concatenate([sa[same], sa[same + 1]])) if len(same) else np.zeros(0, np.int64)
    begin = ends - sizes + 1
    of = piece[hit]
    return [hit[lo:hi] - begin[k] for k, (lo, hi) in
            enumerate(zip(np.searchsorted(of, range(len(pieces))), np.searchsorted(of, range(len(pieces)), side="right")))]


def _runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal covered byte ranges of sorted window starts."""
    if not len(starts):
        return []
    cutp = np.flatnonzero(np.diff(starts) > length)
    lo = np.concatenate([[0], cutp + 1])
    hi = np.concatenate([cutp, [len(starts) - 1]])
    return list(zip(starts[lo].tolist(), (starts[hi] + length).tolist()))


def _ranges(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [()] * 5
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()))],
                    names=[*KEY, "lo", "hi"])


RANGE = "k_id long, k_null boolean, k_hash long, lo long, hi long"


def _sort_block(length: int):
    def run(block: pa.Table) -> pa.Table:
        body = block["body"].to_pylist()
        keys = list(zip(*[block[c].to_pylist() for c in KEY]))
        start, n = block["start"].to_pylist(), block["n"].to_pylist()
        rows = []
        for k, found in enumerate(repeated_starts(body, length)):
            if n[k] == 1:  # contents that occur twice are marked already
                rows += [(*keys[k], start[k] + lo, start[k] + hi) for lo, hi in _runs(found, length)]
        return _ranges(rows)

    return run


def _windows(length: int):
    """Rows (digest of a window, n, key..., lo, hi) of pieces of hot anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, digests = [], []
            for r in batch.to_pylist():
                for i in range(len(r["body"]) - length + 1):
                    digests.append(xxhash.xxh3_128_digest(r["body"][i:i + length]))
                    rows.append((r["n"], r["k_id"], r["k_null"], r["k_hash"], r["start"] + i, r["start"] + i + length))
            cols = list(zip(*rows)) or [()] * 6
            types = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), *[pa.array(c, t) for c, t in zip(cols, types)]],
                                             names=["digest", "n", *KEY, "lo", "hi"])

    return run


# ------------------------------------------------------------------- driver

def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted pieces of each document."""
    for batch in batches:
        rows, out = [], []
        for k, (body, wanted) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())):
            for w in wanted:
                rows.append(k)
                out.append((w["anchor"], w["hot"], w["n"], w["start"], body[w["start"]:w["start"] + w["size"]]))
        cols = list(zip(*out)) or [()] * 5
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(at) for c in range(3)],
             *[pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()))]],
            names=[*KEY, "anchor", "hot", "n", "start", "body"])


def remove_ranges(body: bytes, ranges: list[dict]) -> tuple[int, int, bytes]:
    """(bytes removed, maximal runs removed, bytes kept)."""
    kept, at, removed, runs = [], 0, 0, 0
    for r in sorted(ranges, key=lambda r: (r["lo"], r["hi"])):
        lo, hi = max(r["lo"], at), r["hi"]
        if hi <= lo:
            continue
        if r["lo"] > at or not runs:
            runs += 1
        kept.append(body[at:lo])
        removed += hi - lo
        at = hi
    kept.append(body[at:])
    return removed, runs, b"".join(kept)


def repeated_ranges(docs: DataFrame, scratch: Scratch, length: int = LENGTH, gram: int = GRAM,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(key..., lo, hi)`` byte ranges to remove; ``docs(key..., body)``."""
    pieces = scratch.table(docs.mapInArrow(_pieces(length, gram), "anchor long, content long, size int, k_id long, "
                                           "k_null boolean, k_hash long, start long"), "pieces")
    again = (pieces.groupBy(F.col("anchor").alias("again")).agg(F.count(F.lit(1)).alias("times"))
             .where("times > 1").select("again"))
    shared = scratch.table(pieces.join(again, F.col("anchor") == F.col("again")).drop("again"), "shared")
    contents = scratch.table(
        shared.groupBy("anchor", "content", "size")
        .agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in (*KEY, "start")]), "contents")
    twice = contents.where("n > 1").select(*[F.col(c).alias(f"t_{c}") for c in ("anchor", "content", "size")])
    whole = (shared.join(twice, [F.col(c) == F.col(f"t_{c}") for c in ("anchor", "content", "size")], "left_semi")
             .select(*KEY, F.col("start").alias("lo"), (F.col("start") + F.col("size")).alias("hi")).distinct())
    anchors = scratch.table(
        contents.groupBy(F.col("anchor").alias("c_anchor"))
        .agg(F.count(F.lit(1)).alias("n_contents"), F.sum("size").alias("bytes"),
             F.count(F.when(F.col("n") == 1, 1)).alias("n_single"))
        .where("n_contents > 1 and n_single > 0"), "anchors")
    is_hot = F.col("bytes") > HOT_BLOCKS * block_bytes
    total = anchors.where(~is_hot).agg(F.sum("bytes")).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    wanted = scratch.table(contents.join(anchors, F.col("anchor") == F.col("c_anchor"))
                           .select(*KEY, "anchor", "n", "start", "size", is_hot.alias("hot")), "wanted")
    per_doc = (wanted.groupBy(*[F.col(c).alias(f"w_{c}") for c in KEY])
               .agg(F.collect_list(F.struct("anchor", "hot", "n", "start", "size")).alias("wanted")))
    found = docs.join(
        per_doc, [F.col(c) == F.col(f"w_{c}") for c in KEY]).select(*KEY, "body", "wanted")
    # A repeated row is fetched twice, but its contents have n > 1 already.
    fetched = found.mapInArrow(_fetch, "k_id long, k_null boolean, k_hash long, anchor long, hot boolean, n long, "
                               "start long, body binary")
    out = whole.unionByName(_sorted_blocks(fetched.where("not hot"), blocks, length))
    if anchors.where(is_hot).isEmpty():
        return out
    windows = fetched.where("hot").mapInArrow(
        _windows(length), "digest binary, n long, k_id long, k_null boolean, k_hash long, lo long, hi long")
    many = windows.groupBy(F.col("digest").alias("m_digest")).agg(F.sum("n").alias("m")).where("m > 1")
    return out.unionByName(windows.join(many, F.col("digest") == F.col("m_digest"), "left_semi").select(*KEY, "lo", "hi"))


def _sorted_blocks(fetched: DataFrame, blocks: int, length: int) -> DataFrame:
    return (fetched.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)))
            .groupBy("block").applyInArrow(_sort_block(length), RANGE))


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for body, ranges in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            removed, runs, kept = remove_ranges(body, ranges or [])
            out.append((len(body), removed, runs, kept))
        cols = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.binary())],
            names=[*KEY, "n_bytes", "n_removed", "n_spans", "kept"])


def substring_dedup(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text",
                    **params) -> DataFrame:
    """``(key..., n_bytes, n_removed, n_spans, kept)`` per document; ``kept``
    are the remaining bytes."""
    rows = docs.select(*doc_key(doc_id, text), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))
    # One job from here: both joins of the texts share one exchange.
    per_doc = (repeated_ranges(rows, scratch, **params).distinct().groupBy(*[F.col(c).alias(f"r_{c}") for c in KEY])
               .agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")))
    joined = rows.join(per_doc, [F.col(c) == F.col(f"r_{c}") for c in KEY], "left").select(*KEY, "body", "ranges")
    return joined.mapInArrow(_strip, "k_id long, k_null boolean, k_hash long, n_bytes long, n_removed long, "
                             "n_spans long, kept binary")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """Counts and digest of what is kept, per document."""
    scratch = Scratch(docs.sparkSession, "suffix")
    return scratch.result(substring_dedup(docs, scratch, doc_id, text, **params).select(
        key_id().alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")))
