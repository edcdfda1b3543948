"""Spelling variant grouping by blocked Gram matrices.

Two words are near if one inserted, deleted or replaced letter turns one into
the other. A word's form is its near word of largest count (if that is at
least ``ratio`` times the word's own), its root is where the forms lead.

1. Spark counts the words of all documents.
2. A word becomes a vector of letter counts. One edit changes the vector by a
   squared distance of 1 (longer or shorter by a letter) or 2 (replaced), so
   words are dealt into blocks by the counts of six classes of letters: near
   words are in one block, or in blocks of the same or the next length where
   one letter changed class. Every word stays at home in its block and visits
   those of these neighbour blocks that have a smaller number (21 at most).
3. In a block, |a|^2 + |b|^2 - 2 a.b for all home words and visitors is one
   NumPy matrix product. Pairs at a distance of at most two whose lengths
   allow one edit are kept and compared letter by letter.
4. What leaves a task is, per word, how many near words were seen and the
   best one; Spark adds these up. Forms are followed by path doubling.

A block of more than ``HOME`` words is cut into chunks that are tasks of
their own; visitors go to each, and words of a chunk visit the chunks before
theirs. Visitors stream through, so a task holds one chunk and one slab.

Defined results: null texts have no words; a null ``doc_id`` is an empty text
in front of the colon; repeated rows count again; ties of counts go to the
smallest word in code-point order; an empty table gives no rows; texts are
read whole and words have any length; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, lower_ascii

MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
LETTERS = 26 + 64  # a-z and U+00C0 to U+00FF, in code-point order
CLASSES = 6
#: The classes deal out letters by how common they are in European text.
COMMON = "etaoinsrhldcumfpgwybvkxjqz"
FULL = (1 << 10) - 1  # class counts from here on share a block coordinate
HOME = 2048           # words of a block that stay in one task
SLAB = 1024           # visitors compared at once
BROADCAST_ROWS = 200_000  # of 16 bytes each: at most 3.2 MB


# ------------------------------------------------------------ words

def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, noise: int | None = None) -> DataFrame:
    """``(word, n)``: A-Z lower-cased runs of letters of ``min_length`` letters
    and ``min_count`` occurrences. With ``noise``, a run whose crc32 together
    with its document is a multiple of it loses one letter first."""
    runs = docs.select(F.col(doc_id).cast("string").alias("doc"), F.explode(F.regexp_extract_all(
        F.col(text), F.lit("[A-Za-zÀ-ÿ]{%d,}" % min_length), F.lit(0))).alias("run"))
    runs = runs.select("doc", lower_ascii(F.col("run")).alias("run"))
    if noise:
        key = F.concat(F.coalesce("doc", F.lit("")), F.lit(":"), F.col("run"))
        runs = runs.select("run", F.crc32(key.cast("binary")).alias("h"))
        at = (F.col("h") % F.length("run")).cast("int")
        short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        runs = runs.select(F.when(F.col("h") % noise == 0, short).otherwise(F.col("run")).alias("run"))
    return (runs.where(F.length("run") >= min_length).groupBy(F.col("run").alias("word"))
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


# ------------------------------------------------------------ letter counts

def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All letters (0..LETTERS-1) of the words in a row, and the lengths."""
    flat = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    flat = np.where(flat < 0xC0, flat - np.uint8(97), flat - np.uint8(0xC0 - 26))
    return flat, np.array([len(w) for w in words], np.int64)


def _counts(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Letter counts of each word."""
    at = np.repeat(np.arange(len(lengths)) * LETTERS, lengths) + flat
    return np.bincount(at, minlength=len(lengths) * LETTERS).reshape(-1, LETTERS)


_CLASS = np.array([COMMON.index(chr(97 + k)) % CLASSES for k in range(26)] + [k % CLASSES for k in range(64)])
_TO_CLASS = (_CLASS[:, None] == np.arange(CLASSES)).astype(np.int64)
_STEPS = 10 * np.arange(CLASSES)[::-1]


def _block_numbers(classes: np.ndarray) -> np.ndarray:
    return (np.minimum(classes, FULL) << _STEPS).sum(axis=1)


def _visits(neighbours: bool):
    """(block, visitor, word, n): each word at home and, with ``neighbours``,
    as a visitor of its smaller neighbour blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            classes = _counts(*_letters(batch.column(0).to_pylist())) @ _TO_CLASS
            home = _block_numbers(classes)
            blocks, rows = [home], [np.arange(len(home))]
            for i in range(CLASSES if neighbours else 0):
                for j in (None, *range(i + 1, CLASSES)):  # one of class i less, one of class j more: a smaller number
                    near = classes.copy()
                    near[:, i] -= 1
                    if j is not None:
                        near[:, j] += 1
                    ok = near[:, i] >= 0
                    number = np.where(ok, _block_numbers(np.maximum(near, 0)), home)
                    ok &= number < home  # beyond FULL a step may lead nowhere or up
                    blocks.append(number[ok])
                    rows.append(np.flatnonzero(ok))
            visitor = np.repeat(np.arange(len(blocks)) > 0, [len(r) for r in rows])
            at, block = np.concatenate(rows), np.concatenate(blocks)
            # Beyond FULL two neighbours may share a number: one visit each.
            _, first = np.unique(np.stack([at, block], axis=1), axis=0, return_index=True)
            take = pa.array(at[first])
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[first]), pa.array(visitor[first]), batch.column(0).take(take), batch.column(1).take(take)],
                names=["block", "visitor", "word", "n"])

    return run


# ------------------------------------------------------------ pairs

def one_edit(a: np.ndarray, b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray) -> np.ndarray:
    """Which rows of letters (0 behind the end, as wide as the longest plus
    one) differ by exactly one inserted, deleted or replaced letter."""
    swap = (len_a < len_b)[:, None]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    differs = a != b
    replaced = (len_a == len_b) & (differs.sum(axis=1) == 1)
    # The longer one without its first differing letter is the shorter one.
    later = np.logical_or.accumulate(differs, axis=1)[:, :-1] & (a[:, 1:] != b[:, :-1])
    return replaced | ((np.abs(len_a - len_b) == 1) & ~later.any(axis=1))


class _Words:
    """Words of one task's chunk or slab with their letter counts."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n = words, n
        self.flat, self.lengths = _letters(words)
        self.begin = np.cumsum(self.lengths) - self.lengths
        counts = _counts(self.flat, self.lengths)
        # Squares below 2**24 are exact in 32 bits.
        self.counts = counts.astype(np.float32 if self.lengths.max() < 2800 else np.float64)
        self.squares = (self.counts * self.counts).sum(axis=1)

    def spell(self, at: np.ndarray, width: int) -> np.ndarray:
        """Letters of some words, counted from 1, with zeros up to ``width``."""
        column = np.arange(width)
        inside = column < self.lengths[at, None]
        return np.where(inside, self.flat[np.where(inside, self.begin[at, None] + column, 0)] + np.uint8(1), np.uint8(0))


def near_pairs(a: _Words, b: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in a, in b) of near pairs, by slabs of the Gram matrix."""
    near_a, near_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo in range(0, len(a.words), 256):
        part = slice(lo, lo + 256)
        distance = a.squares[part, None] + b.squares - 2 * (a.counts[part] @ b.counts.T)
        i, j = np.nonzero(distance <= 2)
        ok = (distance[i, j] > 0) & (np.abs(a.lengths[i + lo] - b.lengths[j]) <= 1)  # 0: the same letters
        i, j = i[ok] + lo, j[ok]
        if len(i):
            width = int(max(a.lengths[i].max(), b.lengths[j].max())) + 1
            step = max(1, (1 << 22) // width)
            for k in range(0, len(i), step):
                x, y = i[k:k + step], j[k:k + step]
                keep = one_edit(a.spell(x, width), b.spell(y, width), a.lengths[x], b.lengths[y])
                near_a.append(x[keep])
                near_b.append(y[keep])
    return np.concatenate(near_a), np.concatenate(near_b)


def _best(of: _Words, i: np.ndarray, other: _Words, j: np.ndarray) -> list[tuple]:
    """(word, near words, count of the best, the best) of the words with pairs."""
    if not len(i):
        return []
    place = np.zeros(len(other.words), np.int64)  # in code-point order
    place[sorted(np.unique(j).tolist(), key=other.words.__getitem__)] = np.arange(len(np.unique(j)))
    order = np.lexsort((place[j], -other.n[j], i))
    first = np.flatnonzero(np.diff(i[order], prepend=-1))
    seen = np.bincount(i)
    return [(of.words[i[k]], int(seen[i[k]]), int(other.n[j[k]]), other.words[j[k]]) for k in order[first]]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words within sorted groups (block, chunk, visitor, word, n)."""
    names = ["word", "seen", "best_n", "best"]
    key, home = None, None
    held: list[tuple[list[str], np.ndarray]] = []

    def take() -> _Words:
        out = _Words([w for words, _ in held for w in words], np.concatenate([n for _, n in held]))
        held.clear()
        return out

    def settle() -> list[tuple]:
        """The held rows are the home words, or visitors of them."""
        nonlocal home
        if not held:
            return []
        now = take()
        if home is None:
            home = now
            i, j = near_pairs(home, home)
            return _best(home, i, home, j)
        i, j = near_pairs(now, home)
        return _best(now, i, home, j) + _best(home, j, now, i)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out)) or [()] * 4
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        block, chunk, visitor = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        words, n = batch.column(3).to_pylist(), batch.column(4).to_numpy()
        cuts = (np.flatnonzero((np.diff(block) != 0) | (np.diff(chunk) != 0) | (np.diff(visitor.astype(np.int8)) != 0))
                + 1).tolist()
        out: list[tuple] = []
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            now = (block[lo], chunk[lo], visitor[lo])
            if now != key:
                out += settle()
                if key is None or now[:2] != key[:2]:
                    home = None
                key = now
            if visitor[lo] and home is None:
                continue  # nobody at home
            for at in range(lo, hi, SLAB):
                if visitor[lo] and held and sum(len(w) for w, _ in held) >= SLAB:
                    out += settle()
                end = min(hi, at + SLAB)
                held.append((words[at:end], n[at:end]))
        yield batch_of(out)
    yield batch_of(settle())


# ------------------------------------------------------------ operator

def near_words(words: DataFrame, scratch: Scratch) -> DataFrame:
    """``(word, n_near, best_n, best)`` of every word that has near words, from
    distinct ``words(word, n)``."""
    kind = "block long, visitor boolean, word string, n long"
    visits = words.mapInArrow(_visits(True), kind)
    large = scratch.table(words.mapInArrow(_visits(False), kind).groupBy(F.col("block").alias("large")).agg(F.count(F.lit(1)).alias("size"))
                          .where(F.col("size") > HOME)
                          .select("large", F.ceil(F.col("size") / F.lit(HOME // 2)).cast("int").alias("chunks")), "large")
    n_large = large.count()
    if n_large:
        visits = visits.join(F.broadcast(large) if n_large <= BROADCAST_ROWS else large,
                             F.col("block") == F.col("large"), "left")
        own = F.pmod(F.xxhash64("word"), F.col("chunks").cast("long")).cast("int")
        at = lambda visitor, chunk: F.struct(visitor.alias("visitor"), chunk.alias("chunk"))
        goes = F.when(F.col("chunks").isNull(), F.array(at(F.col("visitor"), F.lit(0)))) \
                .when(F.col("visitor"), F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: at(F.lit(True), c))) \
                .otherwise(F.transform(F.sequence(F.lit(0), own), lambda c: at(c < own, c)))
        visits = visits.select("block", "word", "n", F.explode(goes).alias("goes")).select(
            "block", "goes.chunk", "goes.visitor", "word", "n")
    else:
        visits = visits.select("block", F.lit(0).alias("chunk"), "visitor", "word", "n")
    pairs = (visits.repartition("block", "chunk").sortWithinPartitions("block", "chunk", "visitor")
             .mapInArrow(_compare, "word string, seen long, best_n long, best string"))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best")))
    return (pairs.groupBy("word").agg(F.sum("seen").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best")))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``forms(word, form)`` to ``(word, root)``: forms followed to the last.
    Every form has a larger count than its word, so there are no cycles; a
    round doubles the steps."""
    now, k = scratch.table(forms.select("word", F.col("form").alias("root")), "roots-0"), 0
    while True:
        ahead = now.select(F.col("word").alias("via"), F.col("root").alias("ahead"))
        k += 1
        now = scratch.table(now.join(ahead, F.col("root") == F.col("via"), "left")
                            .select("word", F.coalesce("ahead", "root").alias("root"),
                                    F.col("ahead").isNotNull().alias("moved")), f"roots-{k}")
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", noise: int | None = None,
             ratio: int = RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word."""
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.table(word_counts(docs, doc_id, text, noise=noise), "words")
    near = near_words(words, scratch).withColumnRenamed("word", "of")
    formed = F.col("best_n") >= ratio * F.col("n")
    marked = scratch.table(words.join(near, F.col("word") == F.col("of"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best")).alias("form"),
        F.when(formed, F.col("best_n")).alias("form_n")), "marked")
    last = roots(marked.where("form is not null"), scratch).withColumnRenamed("word", "of")
    return scratch.result(marked.join(last, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
