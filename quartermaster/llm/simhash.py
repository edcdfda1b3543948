"""SimHash near-dedup with deletion-variant signatures.

Fingerprints within ``MAX_BITS`` = 3 bits are linked. The 64 bits are cut
into 2 segments, fewer than the bits allowed to differ plus one, so one
segment of a linked pair differs by at most one bit. Instead of trying all
neighbours, every *distinct* segment value is indexed under its one-wildcard
variants (one bit blanked out): two values meet in a variant if and only if
they differ in that bit alone, so a variant holds two values at most, no
matter how many documents share them. An equality join brings the
fingerprints of equal or neighbouring segment values together in blocks, and
each block is verified on all 64 bits.

Skew: exact copies (and texts of equal fingerprint) are one row from the
start. A block of up to ``BLOCK`` fingerprints is verified in one pass and
returns a spanning forest of its links (fewer rows than members, never all
pairs). The members of a larger block are passed on and cut again by the
same rule on the remaining 32 bits (two halves, one of which differs by at
most one bit); such a cut block leaves 18 free bits, so it can't hold more
than 2**18 fingerprints (2 MB). No link is lost at any size.

Defined results: null and empty texts have no words and fingerprint 0, and
link like any other; a null ``doc_id`` counts as larger than any id (the
component of null ids alone is null); repeated rows are one fingerprint; very
long texts are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KEY, Scratch, doc_key, key_id, pack
from .components import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BLOCK = 4096
LOW32 = (1 << 32) - 1


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of one text (UTF-8)."""
    words = text.lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        hashes = digest(b" ".join(words), SEED)
    elif shingle == 3:
        hashes = b"".join([digest(b"%b %b %b" % x, SEED) for x in zip(words, words[1:], words[2:])])
    else:
        hashes = b"".join([digest(b" ".join(words[i:i + shingle]), SEED)
                           for i in range(len(words) - shingle + 1)])
    raw = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(raw), 255):
        ones += np.add.reduce(np.unpackbits(raw[i:i + 255], axis=1), axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(ones * 2 > len(raw)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``(k_id, k_null, k_hash, fp)``: one row per document. No shuffle."""
    rows = docs.select(*doc_key(doc_id, text),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [simhash(x, shingle) for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps, pa.int64())],
                                             names=[*KEY, "fp"])

    return rows.mapInArrow(run, "k_id long, k_null boolean, k_hash long, fp long")


def _forest(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect what is within ``max_bits``: a spanning forest."""
    links = []
    while len(values) > 1:
        todo, values = [values[0]], values[1:]
        while todo and len(values):
            x = todo.pop()
            near = np.bitwise_count(values ^ x) <= max_bits
            if near.any():
                found, values = values[near], values[~near]
                links += [(int(x), int(y)) for y in found]
                todo.extend(found)
    return links


def _verify(max_bits: int, block: int | None):
    """Verifies sorted ``(blk, fp)`` rows block by block. Rows out:
    ``(a, b, null)`` per link, ``(fp, null, blk)`` per member of a block with
    more than ``block`` members. Holds one block at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "blk"]

        def out(links, large=()):
            a, b = zip(*links) if links else ((), ())
            fps, blks = zip(*large) if large else ((), ())
            signed = np.array(a + b, np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([*signed[:len(a)].tolist(), *fps], pa.int64()),
                 pa.array([*signed[len(a):].tolist(), *[None] * len(fps)], pa.int64()),
                 pa.array([*[None] * len(a), *blks], pa.int64())], names=names)

        held, held_blk, over = [], None, False

        def close():
            values = np.concatenate(held) if held else np.zeros(0, np.int64)
            return _forest(values.view(np.uint64), max_bits) if not over and len(values) > 1 else []

        for batch in batches:
            blks = batch.column(0).to_numpy()
            fps = batch.column(1).to_numpy()
            links, large = [], []
            cuts = np.flatnonzero(np.diff(blks)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(blks)]):
                if hi == lo:
                    continue
                if blks[lo] != held_blk:
                    links += close()
                    held, held_blk, over = [], blks[lo], False
                held.append(fps[lo:hi])
                if block and (over or sum(map(len, held)) > block):
                    over = True
                    large += [(int(x), int(held_blk)) for part in held for x in part]
                    held = []
            yield out(links, large)
        yield out(close())

    return run


def _linked(members: DataFrame, max_bits: int, block: int | None) -> DataFrame:
    """``members(blk, fp)``, dealt and sorted by block, verified."""
    return (members.repartition("blk").sortWithinPartitions("blk", "fp")
            .mapInArrow(_verify(max_bits, block), "a long, b long, blk long"))


def links(distinct_fps: DataFrame, scratch: Scratch, max_bits: int = MAX_BITS,
          block: int = BLOCK) -> DataFrame:
    """``(a, b)`` links that connect all fingerprints within ``max_bits``
    (2 or 3) of each other. ``distinct_fps(fp)`` has no repeats."""
    if not 2 <= max_bits <= 3:
        raise ValueError("two segments with one wildcard bit find 2 or 3 differing bits")
    fp = F.col("fp")
    member = distinct_fps.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("seg"), F.shiftrightunsigned(fp, 32).alias("val")),
        F.struct(F.lit(1).alias("seg"), fp.bitwiseAND(F.lit(LOW32)).alias("val")))).alias("x")
    ).select("fp", "x.seg", "x.val")
    values = scratch.table(member.groupBy("seg", "val").agg(F.count(F.lit(1)).alias("n")), "values")

    # Block ids: the segment, the wildcard bit + 1 (0: none) and the segment
    # value with that bit blanked out, in one long of 39 bits.
    def block_id(bit, val):
        return F.shiftleft((F.col("seg") * 33 + bit + 1).cast("long"), 32).bitwiseOR(val)

    bit = F.col("bit")
    mask = F.expr("shiftleft(1L, bit)")
    # The distinct values are few files; their 32 variants each are dealt to all tasks.
    spread = values.repartition(2 * distinct_fps.sparkSession.sparkContext.defaultParallelism, "val")
    variants = (spread.select("seg", "val", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("bit"))
                .select(block_id(bit, F.col("val").bitwiseAND(F.bitwise_not(mask))).alias("blk"),
                        F.when(F.col("val").bitwiseAND(mask) == 0, 1).otherwise(2).cast("byte").alias("has"))
                .groupBy("blk").agg(F.bit_or("has").alias("has")).where("has = 3")
                .select("blk", (F.shiftrightunsigned("blk", 32) - 1).cast("int").alias("code"),
                        F.col("blk").bitwiseAND(F.lit(LOW32)).alias("base"))
                .select("blk", F.expr("code div 33").cast("int").alias("seg"),
                        F.pmod("code", F.lit(33)).cast("int").alias("bit"), "base"))
    cross = variants.select("blk", "seg", F.explode(F.array(
        F.col("base"), F.col("base").bitwiseOR(mask))).alias("val"))
    equal = values.where("n > 1").select(block_id(F.lit(-1), F.col("val")).alias("blk"), "seg", "val")
    blocks = scratch.table(equal.unionByName(cross), "blocks")

    first = scratch.table(_linked(member.join(blocks, ["seg", "val"]).select("blk", "fp"),
                                  max_bits, block), "verified")
    large = first.where("b is null")
    found = first.where("b is not null").select("a", "b")
    if large.isEmpty():
        return found
    # The other segment of a large block, cut into two halves of 16 bits.
    rest = F.when(F.shiftrightunsigned("blk", 32) < 33, fp.bitwiseAND(F.lit(LOW32))) \
            .otherwise(F.shiftrightunsigned(fp, 32))
    cut = (large.select("blk", F.col("a").alias("fp")).withColumn("rest", rest)
           .select("blk", "fp", F.explode(F.array(
               F.struct(F.lit(0).alias("half"), F.shiftrightunsigned("rest", 16).alias("part")),
               F.struct(F.lit(1).alias("half"), F.col("rest").bitwiseAND(F.lit(0xFFFF)).alias("part")))).alias("x"))
           .select("blk", "fp", "x.half", "x.part", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("bit"))
           .select(F.shiftleft("blk", 21)
                   .bitwiseOR((F.col("half") * (1 << 20) + F.col("bit") * (1 << 16)).cast("long"))
                   .bitwiseOR(F.col("part").bitwiseAND(F.bitwise_not(mask))).alias("blk"), "fp"))
    return found.unionByName(_linked(cut, max_bits, None).select("a", "b"))


def near_dedup(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text",
               shingle: int = SHINGLE, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``(k_id, k_null, k_hash, fp, root)`` for every document: ``root`` is
    the fingerprint that names its component."""
    prints = scratch.table(fingerprints(docs, doc_id, text, shingle), "prints")
    distinct_fps = scratch.table(prints.select("fp").distinct(), "distinct")
    found = links(distinct_fps, scratch, max_bits, block)
    roots = connected_components(found, scratch)
    return (prints.join(roots, F.col("fp") == F.col("node"), "left")
            .select(*KEY, "fp", F.coalesce("root", "fp").alias("root")))


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.table(near_dedup(docs, scratch, doc_id, text, **params), "marked")
    least = marked.groupBy(F.col("root").alias("least_root")).agg(F.min(key_id()).alias("component_id"))
    return scratch.result(marked.join(least, F.col("root") == F.col("least_root")).select(
        key_id().alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id"))


def _draw(docs: DataFrame, besides: tuple[str, ...]) -> Column:
    """A hash of all columns but ``besides``, of any type."""
    cols = [F.col(f"`{f.name}`") if "map<" not in f.dataType.simpleString() else F.to_json(F.struct(F.col(f"`{f.name}`")))
            for f in docs.schema.fields if f.name not in besides]
    return F.xxhash64(F.lit(0), *cols)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """The rows of ``docs`` with one document left of each component: the
    one of least ``doc_id`` (null last, then by text hash; of rows that agree in
    both, the one whose other columns have the least hash). What is left does
    not depend on the order of the input."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash-keep")
    marked = scratch.table(near_dedup(docs, scratch, doc_id, text, **params), "marked")
    best = (marked.groupBy("root")
            .agg(F.min(F.struct("k_null", "k_id", "k_hash")).alias("k"))
            .select(*[F.col(f"k.{c}").alias(f"keep_{c}") for c in KEY]))
    same = [F.col(c) == F.col(f"keep_{c}") for c in KEY]
    rest = docs.select(*doc_key(doc_id, text), _draw(docs, (doc_id, text)).alias("draw"))
    # Of each key the least draw, and how many rows have it.
    times = (rest.groupBy(*KEY, "draw").agg(F.count(F.lit(1)).alias("times"))
             .groupBy(*KEY).agg(F.min(F.struct("draw", "times")).alias("d")))
    keep = scratch.result(times.join(best, same).select(
        *[F.col(f"keep_{c}") for c in KEY], F.col("d.draw").alias("keep_draw"), F.col("d.times").alias("keep_times")))
    rows = docs.select(pack(docs).alias("row"), *doc_key(doc_id, text), _draw(docs, (doc_id, text)).alias("draw")).join(
        keep, [*same, F.col("draw") == F.col("keep_draw")])
    once = rows.where("keep_times = 1").select("row.*")
    # What is left of these keys are copies of one row.
    repeated = rows.where("keep_times > 1").groupBy(*KEY).agg(F.first("row").alias("row")).select("row.*")
    return once.unionByName(repeated)
