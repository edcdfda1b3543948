"""MinHash near-dedup on SetSketch registers.

A document's set is its distinct word shingles. Documents are linked when
their sets' Jaccard similarity is at least ``threshold`` per cent.

1. Each set becomes ``REGISTERS`` registers: the least of the set's hashes in
   [0, 1), turned into an exponential variable of rate ``RATE`` and truncated
   to ``floor(1 - log_b h)`` in 16 bits. Registers of a union are the maxima
   of the registers (:func:`merge`); two registers agree with a probability
   of about the similarity. Equal sets are one *node* from here on.
2. ``BANDS`` bands of ``ROWS`` register values are buckets. At a similarity of
   exactly 0.8 all 40 bands miss with probability 7e-10. Buckets of the same
   few members are merged into one.
3. Inside a bucket the similarity of two nodes is estimated from the numbers
   of greater, smaller and equal registers and both set sizes together, by
   maximum likelihood (Fisher scoring). A pair stays if the estimate is less
   than ``SIGMAS`` standard errors below the threshold. A bucket returns a
   spanning forest of these pairs, never all pairs; the components of all
   forests are clusters that no true link leaves.
4. Inside a cluster the full sets (64-bit shingle hashes) are compared; a
   spanning forest of the confirmed links gives the components. Members that
   are joined already are not compared again.

Skew: copies are one node before any bucket is made. A bucket of more than
``BUCKET`` nodes, or a cluster of more than ``CLUSTER_BYTES`` of sets, is cut
into blocks and every pair of blocks is a task of its own, so a task holds two
blocks at most and every pair is still looked at.

Defined results: null texts and texts without words have an empty set, size 0,
and are linked with nothing; fewer words than a shingle are one shingle; a
null ``doc_id`` counts as larger than any id, a component of null ids alone is
null (and kept); repeated rows share a node; texts are read whole; an empty
table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, Scratch, doc_key, key_id
from .components import connected_components

SHINGLE = 4
THRESHOLD = 80  # per cent
BANDS, ROWS = 40, 4
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
SIGMAS = 6.0
SAME = 64               # buckets of up to so many nodes are known by their members
BUCKET = 8192           # nodes in a block of a bucket
CLUSTER_BYTES = 1 << 25  # bytes of sets in a block of a cluster

_SCALES = np.random.default_rng(20).integers(1, 1 << 63, REGISTERS, dtype=np.uint64) | np.uint64(1)


# ------------------------------------------------------------ sets, registers

def shingle_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a UTF-8 text."""
    words = text.lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh3_64_digest
    if len(words) <= shingle:
        raw = digest(b" ".join(words))
    elif shingle == 4:
        raw = b"".join([digest(b"%b %b %b %b" % x) for x in zip(words, words[1:], words[2:], words[3:])])
    else:
        raw = b"".join([digest(b" ".join(words[i:i + shingle])) for i in range(len(words) - shingle + 1)])
    return np.unique(np.frombuffer(raw, ">u8").astype(np.uint64))


def sketch(items: np.ndarray) -> np.ndarray:
    """The registers of a set of hashes, in bounded memory."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(items), 1024):
        least = np.minimum(least, (items[lo:lo + 1024, None] * _SCALES).min(axis=0))
    exponential = -np.log1p(-(least.astype(np.float64) + 1) / 2.0 ** 64 * (1 - 2.0 ** -53)) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def estimate(greater: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Most likely similarity and its standard error, given how many of
    ``REGISTERS`` registers are greater and less in a than in b, and the sizes.

    With u, v the sizes' shares and p(x) = -log_b(1 - x (b-1)/b), a register is
    greater with probability p(u - vJ), less with p(v - uJ), else equal."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    top = np.minimum(u / v, v / u)  # no sets of these sizes are more similar
    c, ln_b, eps = (BASE - 1) / BASE, np.log(BASE), 1e-9
    equal = REGISTERS - greater - less
    j = np.minimum(0.8, top * 0.999)
    for _ in range(8):
        x, y = np.maximum(u - v * j, eps), np.maximum(v - u * j, eps)
        p, q = -np.log1p(-x * c) / ln_b, -np.log1p(-y * c) / ln_b
        dp, dq = -v * c / (ln_b * (1 - x * c)), -u * c / (ln_b * (1 - y * c))
        r, dr = np.maximum(1 - p - q, eps), -dp - dq
        info = REGISTERS * (dp * dp / p + dq * dq / q + dr * dr / r)
        j = np.clip(j + (greater * dp / p + less * dq / q + equal * dr / r) / info, 1e-6, top * 0.999999)
    return j, 1 / np.sqrt(info)


# ------------------------------------------------------------ forests

def _sketch_near(regs: np.ndarray, sizes: np.ndarray, threshold: int) -> Callable:
    """Which of ``rest`` may be similar to member ``x``, by their sketches."""

    def near(x: int, rest: np.ndarray) -> np.ndarray:
        a, b = sizes[x], sizes[rest]
        ok = 100 * np.minimum(a, b) >= threshold * np.maximum(a, b)
        at = np.flatnonzero(ok)
        if len(at):
            other = regs[rest[at]]
            greater, less = (regs[x] > other).sum(axis=1), (regs[x] < other).sum(axis=1)
            j, error = estimate(greater, less, float(a), b[at].astype(np.float64))
            # Close to the greatest similarity of two sizes the standard error goes to 0.
            ok[at] = j + SIGMAS * np.maximum(error, np.sqrt(0.16 / REGISTERS)) >= threshold / 100
        return ok

    return near


def _exact_near(sets: list[np.ndarray], threshold: int) -> Callable:
    """Which of ``rest`` are similar to member ``x``, by their whole sets."""
    sizes = np.array([len(s) for s in sets])
    items = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    order = np.argsort(items, kind="stable")
    items, owner = items[order], owner[order]

    def near(x: int, rest: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(items, sets[x]), np.searchsorted(items, sets[x], side="right")
        n = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        shared = np.bincount(owner[at], minlength=len(sets))[rest]
        return 100 * shared >= threshold * (sizes[x] + sizes[rest] - shared)

    return near


def forest(n: int, near: Callable) -> list[tuple[int, int]]:
    """Links that connect the members 0..n-1 as all pairs that are ``near``
    would: a spanning forest."""
    links, rest = [], np.arange(n)
    while len(rest) > 1:
        todo, rest = [int(rest[0])], rest[1:]
        while todo and len(rest):
            x = todo.pop()
            found = near(x, rest)
            if found.any():
                links += [(x, int(y)) for y in rest[found]]
                todo += rest[found].tolist()
                rest = rest[~found]
    return links


# ------------------------------------------------------------ task side

def _prints(shingle: int):
    """(key..., node, n_shingles, registers) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, regs = [], [], []
            for text in batch.column(3).to_pylist():
                items = shingle_set(text, shingle)
                sizes.append(len(items))
                nodes.append(xxhash.xxh3_64_intdigest(items.tobytes()) - (1 << 63) if len(items) else None)
                regs.append(sketch(items).tobytes() if len(items) else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(regs, pa.binary())], names=[*KEY, "node", "n_shingles", "regs"])

    return run


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(band, value, node): one row per band of each node."""
    for batch in batches:
        if not batch.num_rows:
            continue
        regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16)
        values = regs.view(np.int64)  # ROWS registers of 16 bits
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)), pa.array(values),
             pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))], names=["band", "value", "node"])


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, block, node) of every bucket with two nodes at least, from rows
    sorted by band, value and node. A bucket of up to ``SAME`` nodes is known
    by a hash of them. Holds ``SAME`` nodes and one batch."""
    names = ["bucket", "block", "node"]
    held: list[int] = []
    key, count = None, 0

    def rows(bucket: int, nodes: list[int], first: int) -> list[tuple]:
        return [(bucket, (first + k) // BUCKET, x) for k, x in enumerate(nodes)]

    def named(key) -> int:
        return xxhash.xxh3_64_intdigest(f"{key[0]}:{key[1]}") - (1 << 63)

    def close() -> list[tuple]:
        if not 2 <= len(held) <= SAME:
            return []
        return rows(xxhash.xxh3_64_intdigest(np.array(held, np.int64).tobytes()) - (1 << 63), held, 0)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64()))],
                                          names=names)

    for batch in batches:
        band, value, node = (c.to_numpy() for c in batch.columns)
        cuts = np.flatnonzero((np.diff(band) != 0) | (np.diff(value) != 0)) + 1
        los, his = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(band)]])
        # A bucket of one node that neither begins nor ends the batch is over.
        many = np.flatnonzero((his - los > 1) | (los == 0) | (his == len(band)))
        out: list[tuple] = []
        for lo, hi in zip(los[many].tolist(), his[many].tolist()):
            if hi == lo:
                continue
            now = (int(band[lo]), int(value[lo]))
            if now != key:
                out += close()
                held, key, count = [], now, 0
            part = node[lo:hi].tolist()
            if count <= SAME < count + len(part):  # too many to be held
                out += rows(named(key), held + part, 0)
                held = []
            elif count > SAME:
                out += rows(named(key), part, count)
            else:
                held += part
            count += len(part)
        yield batch_of(out)
    yield batch_of(close())


def _forests(make_near: Callable, n_keys: int):
    """Links (a, b) inside each group of rows (key columns..., node, ...),
    sorted by key. Holds one group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close() -> list[tuple[int, int]]:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]
            nodes, first = np.unique(rows.column(n_keys).to_numpy(), return_index=True)
            if len(nodes) < 2:
                return []
            if len(first) < rows.num_rows:
                rows = rows.take(pa.array(first))
            else:
                nodes = rows.column(n_keys).to_numpy()
            return [(int(nodes[x]), int(nodes[y])) for x, y in forest(len(nodes), make_near(rows, n_keys + 1))]

        def key_of(batch: pa.RecordBatch, at: int) -> tuple:
            return tuple(batch.column(c)[at].as_py() for c in range(n_keys))

        def links(found: list[tuple[int, int]]) -> pa.RecordBatch:
            a, b = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            change = np.zeros(batch.num_rows - 1, bool)
            for c in range(n_keys):
                change |= np.diff(batch.column(c).to_numpy()) != 0
            cuts = (np.flatnonzero(change) + 1).tolist()
            found = []
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                now = key_of(batch, lo)
                if now != key and held:
                    found += close()
                    held = []
                key = now
                held.append(batch.slice(lo, hi - lo))
            yield links(found)
        if held:
            yield links(close())

    return run


def _by_sketch(threshold: int):
    def make(rows: pa.RecordBatch, at: int) -> Callable:
        regs = np.frombuffer(b"".join(rows.column(at + 1).to_pylist()), np.uint16).reshape(-1, REGISTERS)
        return _sketch_near(regs, rows.column(at).to_numpy(), threshold)
    return make


def _by_set(threshold: int):
    def make(rows: pa.RecordBatch, at: int) -> Callable:
        return _exact_near([np.frombuffer(x, np.uint64) for x in rows.column(at).to_pylist()], threshold)
    return make


def _sets(shingle: int):
    """(cluster, part..., node, set) from (cluster, parts, node, text). Of
    repeated rows, a task passes on the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            take = []
            for k, node in enumerate(batch.column(2).to_pylist()):
                if node not in seen:
                    seen.add(node)
                    take.append(k)
            few = batch.take(pa.array(take, pa.int64()))
            items = [shingle_set(x, shingle).tobytes() for x in few.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*few.columns[:3], pa.array(items, pa.binary())],
                                             names=["cluster", "blocks", "node", "items"])

    return run


# ------------------------------------------------------------ operator

def _block_pairs(block, blocks):
    """The tasks of a member of ``block``: every pair of it with another block
    of its group, or the one task of a group of one block."""
    alone = F.array(F.struct(F.lit(0).alias("lo"), F.lit(0).alias("hi")))
    others = F.filter(F.sequence(F.lit(0), blocks - 1), lambda j: j != block)
    return F.explode(F.when(blocks == 1, alone).otherwise(F.transform(others, lambda j: F.struct(
        F.least(j, block).alias("lo"), F.greatest(j, block).alias("hi")))))


def _grouped(members: DataFrame, key: str, make_near: Callable) -> DataFrame:
    """``members(key, lo, hi, node, ...)`` to their links."""
    keys = [key, "lo", "hi"]
    return (members.repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(_forests(make_near, 3), "a long, b long"))


def links(docs: DataFrame, nodes: DataFrame, scratch: Scratch, shingle: int, threshold: int) -> DataFrame:
    """Confirmed links ``(a, b)`` that connect all nodes within ``threshold``.
    ``docs(key..., body)``; ``nodes(node, n_shingles, regs, key...)``."""
    bands = nodes.select("node", "regs").mapInArrow(_band_keys, "band int, value long, node long")
    order = ["band", "value"]
    members = scratch.table(
        bands.repartition(*order).sortWithinPartitions(*order, "node")
        .mapInArrow(_buckets, "bucket long, block int, node long").distinct(), "members")
    large = (members.groupBy(F.col("bucket").alias("large")).agg((F.max("block") + 1).alias("n"))
             .where("n > 1"))
    sketched = (members.join(large, F.col("bucket") == F.col("large"), "left")
                .select("bucket", "node", _block_pairs(F.col("block"), F.coalesce("n", F.lit(1))).alias("task"))
                .join(nodes.select("node", "n_shingles", "regs"), "node")
                .select("bucket", "task.lo", "task.hi", "node", "n_shingles", "regs"))
    likely = scratch.table(_grouped(sketched, "bucket", _by_sketch(threshold)), "likely")
    rounds = Scratch(docs.sparkSession, "setsketch-clusters")
    roots = connected_components(likely, rounds)
    cluster = scratch.table(
        roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        .join(nodes.select("node", "n_shingles", *KEY), "node"), "cluster")
    rounds.drop()
    sizes = cluster.groupBy(F.col("root").alias("of")).agg(
        F.ceil(F.sum(F.col("n_shingles") * 8) / F.lit(CLUSTER_BYTES)).cast("int").alias("blocks"))
    wanted = cluster.join(sizes, F.col("root") == F.col("of")).select(
        F.col("root").alias("cluster"), "blocks", "node", *[F.col(c).alias(f"w_{c}") for c in KEY])
    # Always a shuffle of the texts: the same plan at every size.
    full = (docs.join(wanted.hint("merge"), [F.col(c) == F.col(f"w_{c}") for c in KEY])
            .select("cluster", "blocks", "node", "body")
            .mapInArrow(_sets(shingle), "cluster long, blocks int, node long, items binary")
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
            .select("cluster", "node", "items", _block_pairs(F.col("block"), F.col("blocks")).alias("task"))
            .select("cluster", "task.lo", "task.hi", "node", "items"))
    return scratch.table(_grouped(full, "cluster", _by_set(threshold)), "confirmed")


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
               threshold: int = THRESHOLD) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.
    ``threshold`` is a per cent, 80 at least (the bands are made for that)."""
    if not 80 <= threshold <= 100:
        raise ValueError("the bands find similarities of 80 per cent or more")
    scratch = Scratch(docs.sparkSession, "setsketch")
    rows = docs.select(*doc_key(doc_id, text), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))
    prints = scratch.table(rows.mapInArrow(
        _prints(shingle), "k_id long, k_null boolean, k_hash long, node long, n_shingles long, regs binary"), "prints")
    nodes = scratch.table(
        prints.where("node is not null").groupBy("node")
        .agg(F.first("n_shingles").alias("n_shingles"), F.first("regs").alias("regs"), F.min(key_id()).alias("least"),
             F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEY)).alias("k"))
        .select("node", "n_shingles", "regs", "least", "n", "k.*"), "nodes")
    roots = connected_components(links(rows, nodes, scratch, shingle, threshold), scratch)
    named = (nodes.select("node", "least", "n").join(roots.withColumnRenamed("node", "linked"),
                                                     F.col("node") == F.col("linked"), "left")
             .select("node", "least", "n", F.coalesce("root", "node").alias("root")))
    named = scratch.table(named, "named")
    least = (named.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component_id"), F.sum("n").alias("docs"))
             .where("docs > 1"))
    shared = scratch.table(named.join(least, F.col("root") == F.col("of"))
                           .select(F.col("node").alias("in_node"), "component_id"), "shared")
    component = F.when(F.col("in_node").isNotNull(), F.col("component_id")).otherwise(key_id())
    out = prints.select(*KEY, "node", "n_shingles").join(shared, F.col("node") == F.col("in_node"), "left")
    return scratch.result(out.select(key_id().alias("doc_id"), "n_shingles", component.alias("component_id"),
                                     key_id().eqNullSafe(component).alias("kept")))
