"""Language ID by word-first backoff.

Words the model knows are scored by their log frequency in each language.
An unseen word falls back to its character n-grams, from the longest length
at which any of its n-grams is known down to single characters.

Training runs on Spark: every task counts the words and n-grams of its
documents and Spark adds the counts up. It reads a sample bounded per
language (``max_docs``, chosen by a hash of the row, so it does not depend
on the layout), and keeps every language and every word and n-gram counted
twice or more. Prediction reads every whole text and never looks at ``lang``,
``source`` or ``doc_id``.

The model is sparse: per kind (words, n-grams of each length) the sorted
64-bit hashes of its tokens, and of each token the languages that have it. Its
size follows the training sample, not the corpus. It is broadcast if its pairs
of token and language take ``max_bytes`` at most; a task then scores a slab of
texts by array operations, and nothing is shuffled. Beside the Arrow batch that
Spark hands it, a task holds one slab of texts (``SLAB``, whole texts) and, in
training, the words and n-grams within ``HELD`` and ``GRAMS``; none of these
bounds changes a result. Beyond that bound the most
frequent words that fit are broadcast, and the other words leave as (document,
word, count) for a join with the written table; each distinct one is looked
up, or taken apart into n-grams, once. The bound decides what is broadcast,
not what is predicted.

Defined results: null text or text without a letter gives ``und`` with score
0; an empty training set gives ``und`` for everything; ties go to the first
language by code point; very long texts are counted whole; an empty table gives
no rows; the caller's columns travel in ``row`` whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import Scratch, pack, slices

UNKNOWN = "und"
MAX_DOCS = 10_000
MAX_BYTES = 1 << 26
PAIR_BYTES = 16         # of the broadcast model, per token and language, at most
SLAB = 1 << 20          # bytes of text counted or scored at once
HELD = 1 << 22          # letters of the distinct words that a training task holds
GRAMS = 1 << 18         # distinct n-grams of them that are held at once
SUMS = 1 << 17          # log scores of words held at once when they are added up
SCALE = 1 << 28  # joined log ratios are added as whole numbers, in any order
NGRAMS = (5, 4, 3, 2, 1)
KINDS = (0, *NGRAMS)    # 0: whole words
LETTERS = re.compile(r"[^\W\d_]+")


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32(doc_id as text) mod 3 is 1; false for a null id."""
    rest = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3))
    return F.coalesce(rest == 1, F.lit(False))


def _grams(word: str, n: int) -> list[str]:
    padded = f"^{word}$" if n > 1 else word
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def _slabs(batch: pa.RecordBatch, texts: Callable) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """The batch in slices of whole rows of about ``SLAB`` bytes of text, with
    their texts; ``texts`` finds the column of a slice."""
    sizes = pc.fill_null(pc.binary_length(texts(batch)), 0).to_numpy(zero_copy_only=False)
    for part in slices(batch, sizes, SLAB):
        yield part, texts(part).to_pylist()


def _tokens(words: Counter, at: int) -> Iterator[pa.RecordBatch]:
    """Words of a language and their n-grams with their counts, kind by kind,
    about ``GRAMS`` at once."""

    def batch(n: int, tokens: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(tokens), at), pa.int32()), pa.array(np.full(len(tokens), n), pa.int32()),
             pa.array(list(tokens), pa.string()), pa.array(list(tokens.values()), pa.int64())],
            names=["at", "n", "token", "count"])

    yield batch(0, words)
    for n in NGRAMS:
        grams: Counter = Counter()
        for w, c in words.items():
            for g in _grams(w, n):
                grams[g] += c
            if len(grams) >= GRAMS:
                yield batch(n, grams)
                grams = Counter()
        yield batch(n, grams)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task side: counts leave when the words held have ``HELD`` letters."""
    per_lang: dict[int, Counter] = {}
    for part, texts in (x for b in batches for x in _slabs(b, lambda part: part.column(1))):
        for at, text in zip(part.column(0).to_pylist(), texts):
            per_lang.setdefault(at, Counter()).update(LETTERS.findall(text.lower()))
        if sum(len(w) for words in per_lang.values() for w in words) >= HELD:
            while per_lang:
                yield from _tokens(*per_lang.popitem()[::-1])
    while per_lang:
        yield from _tokens(*per_lang.popitem()[::-1])


def train(docs: DataFrame, text: str = "text", lang: str = "lang", max_docs: int = MAX_DOCS,
          max_bytes: int = MAX_BYTES) -> dict:
    """The model: ``langs``; per kind in ``tokens`` the sorted token hashes with
    their ``begin`` in ``at`` (language) and ``ratio`` (log ratio to the floor);
    ``floor``: per kind, the log probability of a token that a language lacks;
    ``table``: the written table of all tokens if not all are in the model.

    ``docs`` holds the rows that may be learned from. ``max_docs`` bounds the
    sample per language, ``max_bytes`` the broadcast part of the model."""
    spark = docs.sparkSession
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"),
                       F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]),
                              F.lit(1 << 20)).alias("draw")).where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return {"langs": [], "tokens": {}, "floor": None, "table": None}
    known = spark.createDataFrame([(x, i, int((1 << 20) * min(1.0, max_docs / sizes[x])))
                                   for i, x in enumerate(langs)], "known string, at int, below long")
    sample = (rows.join(F.broadcast(known), F.col("lang") == F.col("known"))
              .where(F.col("draw") < F.col("below")).select("at", "text"))
    counts = (sample.mapInArrow(_count, "at int, n int, token string, count long")
              .groupBy("n", "token", "at").agg(F.sum("count").alias("count")))
    per_token = (counts.groupBy("n", "token")
                 .agg(F.sum("count").alias("total"),
                      F.collect_list(F.struct("at", "count")).alias("by_lang"))
                 .where("total >= 2"))
    scratch = Scratch(spark, "lang-id")
    per_token = scratch.result(per_token)
    sums = np.zeros((len(KINDS), len(langs)))
    n_tokens = np.zeros((len(KINDS), 1))
    pairs = 0
    for r in per_token.groupBy("n").agg(F.count(F.lit(1)).alias("tokens"), F.sum(F.size("by_lang")).alias("pairs")).collect():
        n_tokens[KINDS.index(r["n"])] = r["tokens"]
        pairs += r["pairs"]
    for r in (per_token.select("n", F.inline("by_lang")).groupBy("n", "at")
              .agg(F.sum("count").alias("count")).collect()):
        sums[KINDS.index(r["n"]), r["at"]] = r["count"]
    floor = np.log(0.1 / (sums + 0.1 * n_tokens + 1))
    whole = pairs * PAIR_BYTES <= max_bytes
    shared = per_token
    if not whole:  # a word has a pair per language at most
        shared = (per_token.where("n = 0").orderBy(F.desc("total"), "token")
                  .limit(max(1, max_bytes // PAIR_BYTES // len(langs))))
    found = shared.select("n", F.xxhash64("token").alias("hash"), F.inline("by_lang")).toArrow()
    n, hashes, at, times = (found[c].to_numpy() for c in ("n", "hash", "at", "count"))
    tokens = {}
    for kind in KINDS:
        mine = np.flatnonzero(n == kind)
        h = hashes[mine].view(np.uint64)
        mine = mine[np.lexsort((at[mine], h))]
        h, first = np.unique(hashes[mine].view(np.uint64), return_index=True)
        tokens[kind] = (h, np.append(first, len(mine)), at[mine].astype(np.int32),
                        np.log((times[mine] + 0.1) / 0.1).astype(np.float32))
    if whole:
        scratch.drop_result()
    return {"langs": langs, "tokens": tokens, "floor": floor, "table": None if whole else per_token}


def lookup(words: list[str], model: dict, kind: int) -> np.ndarray:
    """Place of each token in the model, -1 if it is not there."""
    known = model["tokens"][kind][0]
    if not words or not len(known):
        return np.full(len(words), -1)
    hashes = np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), 42) for w in words], np.uint64)
    place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[place] == hashes, place, -1)


def _spread(model: dict, kind: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position in ``place``, language, log ratio) of the tokens' pairs."""
    _, begin, at, ratio = model["tokens"][kind]
    n = begin[place + 1] - begin[place]
    which = np.repeat(np.arange(len(place)), n)
    pair = np.arange(n.sum()) + np.repeat(begin[place] - (np.cumsum(n) - n), n)
    return which, at[pair], ratio[pair].astype(np.float64)


def evidence(words: list[str], model: dict, backoff: bool = True) -> tuple[np.ndarray, ...]:
    """What the model says of distinct words: the kind of each word's tokens (-1:
    no evidence), and (word, language, log ratio) of what differs from the
    floor. A word's n-grams share its weight, so it counts once."""
    kinds = np.full(len(words), -1)
    place = lookup(words, model, 0)
    found = np.flatnonzero(place >= 0)
    kinds[found] = 0
    which, at, ratio = _spread(model, 0, place[found])
    parts = [(found[which], at, ratio)]
    left = [k for k in np.flatnonzero(place < 0).tolist() if any(map(str.isalpha, words[k]))] if backoff else []
    for n in NGRAMS:
        if not left:
            break
        ids: dict[str, int] = defaultdict(count().__next__)
        grams = [[ids[g] for g in _grams(words[k], n)] for k in left]
        of = np.repeat(np.arange(len(left)), [len(g) for g in grams])
        place = lookup(list(ids), model, n)[np.array([g for gs in grams for g in gs], np.int64)]
        of, place = of[place >= 0], place[place >= 0]
        times = np.bincount(of, minlength=len(left))
        which, at, ratio = _spread(model, n, place)
        settled = np.array(left)
        parts.append((settled[of[which]], at, ratio / times[of[which]]))
        kinds[settled[times > 0]] = n
        left = settled[times == 0].tolist()
    return kinds, *(np.concatenate(x) for x in zip(*parts))


def scores(texts: list[str | None], model: dict) -> tuple[np.ndarray, list[bool]]:
    """Log scores of each text in each language, and whether it has a letter."""
    n_langs = len(model["langs"])
    total, letter = np.zeros((len(texts), n_langs)), []
    ids: dict[str, int] = defaultdict(count().__next__)
    tokens = [np.fromiter(map(ids.__getitem__, LETTERS.findall(t.lower())) if t else (), np.int64) for t in texts]
    words = list(ids)
    has = np.array([any(map(str.isalpha, w)) for w in words], bool)
    letter = [bool(len(x)) and bool(has[x].any()) for x in tokens]
    if not words:
        return total, letter
    kinds, word, at, ratio = evidence(words, model)
    # (document, word) pairs with their counts.
    doc = np.repeat(np.arange(len(texts)), [len(x) for x in tokens])
    pair, times = np.unique(doc * len(words) + np.concatenate(tokens), return_counts=True)
    doc, of = pair // len(words), pair % len(words)
    seen = kinds[of] >= 0
    kind = np.searchsorted(np.array(KINDS)[KIND_ORDER], kinds[of][seen])
    per_kind = np.bincount(doc[seen] * len(KINDS) + KIND_ORDER[kind], times[seen], len(texts) * len(KINDS))
    total += per_kind.reshape(-1, len(KINDS)) @ model["floor"]
    order = np.argsort(word, kind="stable")
    word, at, ratio = word[order], at[order], ratio[order]
    lo = np.searchsorted(word, of)
    n = np.searchsorted(word, of, side="right") - lo
    entry = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
    total += np.bincount(np.repeat(doc, n) * n_langs + at[entry], np.repeat(times, n) * ratio[entry],
                         len(texts) * n_langs).reshape(-1, n_langs)
    return total, letter


KIND_ORDER = np.argsort(KINDS)


def _named(total: np.ndarray, letter: list[bool], langs: list[str]) -> tuple[list[str], list[float]]:
    """Languages and probabilities of log scores."""
    if not langs or not len(total):
        return [UNKNOWN] * len(total), [0.0] * len(total)
    p = np.exp(total - total.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    best = p.argmax(axis=1)
    return ([langs[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), letter)],
            [x if ok else 0.0 for x, ok in zip(p[np.arange(len(p)), best].tolist(), letter)])


def _whole_part(shared, place: int | None):
    """Task side: scores all words of the texts, slab by slab. The text is field
    ``place`` of the row, or a column of its own."""

    def find(batch: pa.RecordBatch) -> pa.Array:
        return batch.column(1) if place is None else batch.column(0).field(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        langs = model["langs"]
        for part, texts in (x for b in batches for x in _slabs(b, find)):
            names, probs = (_named(*scores(texts, model), langs) if langs
                            else ([UNKNOWN] * len(texts), [0.0] * len(texts)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(probs, pa.float64())],
                                             names=["row", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``(row, lang_pred, score)``: the input row as a struct, the predicted
    language and its probability. No shuffle if the model is broadcast whole."""
    if model["table"] is not None:
        return _predict_joined(docs, model, text)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    # The row holds the text already: sent once where it is a column.
    place = next((k for k, f in enumerate(docs.schema)
                  if f.name == text and "." not in text and isinstance(f.dataType, StringType)), None)
    rows = docs.select(pack(docs).alias("row"), *([F.col(text).cast("string").alias("text")] if place is None else []))
    return rows.mapInArrow(_whole_part(shared, place), StructType([
        rows.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


def _shared_part(shared):
    """Task side: scores the broadcast words of each text; the others leave
    with their counts, slab by slab. Equal texts of a batch leave once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            seen: set[tuple[int, int]] = set()
            for part, texts in _slabs(batch, lambda part: part.column(2)):
                out = []
                for k_hash, k_mix, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts):
                    if (k_hash, k_mix) in seen:
                        continue
                    seen.add((k_hash, k_mix))
                    words = Counter(LETTERS.findall(t.lower())) if t else {}
                    names, times = list(words), np.array(list(words.values()), np.float64)
                    kinds, word, at, ratio = evidence(names, model, backoff=False)
                    total = model["floor"][0] * times[kinds == 0].sum() + np.bincount(
                        at, times[word] * ratio, len(model["langs"]))
                    rest = np.flatnonzero(kinds < 0).tolist()
                    letter = any(any(map(str.isalpha, w)) for w in words)
                    out.append((number, k_hash, k_mix, letter, total, [names[k] for k in rest],
                                [words[names[k]] for k in rest]))
                    number += 1
                cols = list(zip(*out)) or [()] * 7
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.float64()),
                         pa.list_(pa.string()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=["doc", "k_hash", "k_mix", "letter", "total", "words", "counts"])

    return run


def _take_apart(n: int):
    """Task side: the n-grams of words that the model lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(w, g, c) for w in batch.column(0).to_pylist() if any(map(str.isalpha, w))
                   for g, c in Counter(_grams(w, n)).items()]
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())],
                names=["word", "gram", "times"])

    return run


def _vectors(words: DataFrame, table: DataFrame, scratch: Scratch) -> DataFrame:
    """``(word, vector)`` of each of ``words`` that has evidence: per language
    the mean log ratio to ``floor`` (in units of 1 / SCALE), and 1 at -1 - n
    for the kind of its tokens."""
    one = F.lit(1).cast("long")
    ratio = lambda x: F.round(F.log((x["count"] + 0.1) / 0.1) * SCALE).cast("long")
    whole = scratch.table(words.join(table.where("n = 0").select(F.col("token").alias("word"), "by_lang"),
                                     "word", "left"), "words")
    vectors = whole.where("by_lang is not null").select("word", F.concat(
        F.array(F.struct(F.lit(-1).alias("at"), one.alias("v"))),
        F.transform("by_lang", lambda x: F.struct(x["at"].alias("at"), ratio(x).alias("v")))).alias("vector"))
    n_found = F.filter("parts", lambda x: x["at"] < 0)[0]["v"]
    left = whole.where("by_lang is null").select("word")
    for n in NGRAMS:  # a word leaves with the first length that any of its n-grams is known of
        grams = (left.repartition(words.sparkSession.sparkContext.defaultParallelism, "word")
                 .mapInArrow(_take_apart(n), "word string, gram string, times long"))
        found = grams.join(table.where(F.col("n") == n).select(F.col("token").alias("gram"), "by_lang"), "gram")
        # At -1: how many of the word's n-grams are known.
        parts = found.select("word", F.inline(F.concat(
            F.array(F.struct(F.lit(-1).alias("at"), F.col("times").alias("v"))),
            F.transform("by_lang", lambda x: F.struct(x["at"].alias("at"), (ratio(x) * F.col("times")).alias("v"))))))
        parts = (parts.groupBy("word", "at").agg(F.sum("v").alias("v"))
                 .groupBy("word").agg(F.collect_list(F.struct("at", "v")).alias("parts")))
        backed = scratch.table(parts.withColumn("n_found", n_found).select("word", F.concat(
            F.array(F.struct(F.lit(-1 - n).alias("at"), one.alias("v"))),
            F.transform(F.filter("parts", lambda x: x["at"] >= 0), lambda x: F.struct(
                x["at"].alias("at"), F.round(x["v"] / F.col("n_found")).cast("long").alias("v")))).alias("vector")),
            f"backed-{n}")
        vectors = vectors.unionByName(backed)
        left = scratch.table(left.join(backed.select("word"), "word", "left_anti"), f"left-{n}")
        if left.isEmpty():
            break
    return vectors


def _predict_joined(docs: DataFrame, model: dict, text: str) -> DataFrame:
    """:func:`predict` with the words that are not broadcast joined to the
    model's table. A text is known by 96 bits of hash."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lang-id-predict")
    table, langs, floor = model["table"], model["langs"], model["floor"]
    shared = spark.sparkContext.broadcast({k: model[k] for k in ("langs", "tokens", "floor")})
    key = [F.xxhash64(F.col(text)).alias("k_hash"), F.hash(F.col(text)).alias("k_mix")]
    thin = scratch.table(docs.select(*key, F.col(text).alias("text")).mapInArrow(
        _shared_part(shared), "doc long, k_hash long, k_mix int, letter boolean, total array<double>, "
        "words array<string>, counts array<long>"), "thin")
    pairs = thin.select("doc", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("times"))))
    vectors = _vectors(pairs.select("word").distinct(), table, scratch)
    sums = (pairs.join(vectors, "word").select("doc", "times", F.inline("vector"))
            .groupBy("doc", "at").agg(F.sum(F.col("v") * F.col("times")).alias("v"))
            .groupBy("doc").agg(F.collect_list(F.struct("at", "v")).alias("sums")))
    kind_of = {-1 - n: k for k, n in enumerate((0, *NGRAMS))}

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (x for b in batches for x in slices(
                b, pc.fill_null(pc.list_value_length(b.column(4)), 0).to_numpy(zero_copy_only=False) + len(langs), SUMS)):
            totals, letters = np.zeros((part.num_rows, len(langs))), []
            for total, letter, start, sums in zip(totals, *(c.to_pylist() for c in part.columns[2:])):
                total += start
                for x in sums or ():
                    if x["at"] < 0:
                        total += x["v"] * floor[kind_of[x["at"]]]
                    else:
                        total[x["at"]] += x["v"] / SCALE
                letters.append(letter or bool(sums))
            names, probs = _named(totals, letters, langs)
            yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(names, pa.string()), pa.array(probs, pa.float64())],
                                             names=["k_hash", "k_mix", "lang_pred", "score"])

    found = (thin.join(sums, "doc", "left").select("k_hash", "k_mix", "letter", "total", "sums")
             .mapInArrow(finish, "k_hash long, k_mix int, lang_pred string, score double"))
    found = scratch.result(found.groupBy(F.col("k_hash").alias("of_hash"), F.col("k_mix").alias("of_mix"))
                           .agg(F.max_by(F.struct("lang_pred", "score"), "score").alias("found")))
    rows = docs.select(pack(docs).alias("row"), *key)
    return (rows.join(found, (F.col("k_hash") == F.col("of_hash")) & (F.col("k_mix") == F.col("of_mix")), "left")
            .select("row", "found.lang_pred", "found.score"))


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
             learn_from: DataFrame | None = None, **bounds) -> DataFrame:
    """Train on the documents that are not held out and predict all."""
    base = docs if learn_from is None else learn_from
    cols = [F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")]
    model = train(base.select(*cols).where(~held_out()), **bounds)
    return predict(docs, model, text)
