"""Mixing sources to target weights by pivotal dependent rounding.

A document of ``size`` words whose source shall deliver ``target`` of its
``source_size`` words is taken ``target / source_size`` times. The whole part
is certain; the fraction is rounded by pivotal moves: two fractional
documents are paired and *words* move between them, at random but with the
right expectation, until one is rounded. The total of the pair stays, so a
source ends within one document of its target.

The moves run as a reduction tree. Documents are dealt into buckets of about
``bucket_rows`` by a hash of their row and, for equal rows, a repeat number
(each bucket holds documents of every source, so a hot source, id or text is
spread over all buckets); a bucket rounds all but at most one
document of each source. The residuals of ``fan_in`` neighbouring buckets
meet on the next level, and so on, until one residual per source is left,
which is rounded by a draw. Only hashes, sizes and masses go through the tree;
the rows are joined to the outcome. Every level is written to the shared folder.
Every draw is a hash of the documents paired, so reruns agree, whatever the
layout of the input.

Targets: sources weigh 3, 1, 2, repeating, in code-point order (null last),
and share 150 % of all words; no target exceeds twice its source, the excess
goes to the others by weight (rounds of one small aggregation each until
none is above).

Defined results: null or word-free texts have size 0 and are taken 0 words;
rows without a source form one source, the last; repeated rows are separate
documents; an empty table gives an empty mix.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import ordinal, prefix_sum
from .common import SPACE_WORD, Scratch, pack

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CEILING = 2.0
SEED = 42
BUCKET_ROWS = 16_384
FAN_IN = 64


def word_count(text: str):
    """Words of a text column; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, scratch: Scratch, weights: Sequence[float] = WEIGHTS,
            share: float = SHARE, ceiling: float = CEILING) -> DataFrame:
    """``(source, source_size, target)`` of ``sized(source, size)``."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = ordinal(sums.withColumn("no_source", F.col("source").isNull()), ["no_source", "source"],
                     name="rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    table = scratch.table(placed.select("source", "source_size", weight.alias("weight"),
                                        (F.col("source_size") * float(ceiling)).alias("most")), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    wanted = share * total
    # What the sources below their ceiling get per unit of weight.
    rate, capped = 0.0, -1
    while True:
        free = F.col("weight") * rate < F.col("most")
        row = table.agg(F.sum(F.when(free, F.col("weight"))).alias("w"),
                        F.sum(F.when(~free, F.col("most"))).alias("fixed"),
                        F.count(F.when(~free, 1)).alias("n")).first()
        if row["n"] == capped or not row["w"]:
            break
        capped = row["n"]
        rate = (wanted - (row["fixed"] or 0.0)) / row["w"]
    return table.select("source", "source_size",
                        F.least("most", F.col("weight") * F.lit(float(rate))).alias("target"))


# ------------------------------------------------------------ pivotal moves

def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pivotal(group: np.ndarray, size: np.ndarray, mass: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Rounds ``mass`` (words taken, 0 < mass < size) within each ``group``
    to 0 or ``size``, but for at most one document per group. Rows must be
    sorted by group. Each round pairs neighbours and settles half of them."""
    mass = mass.astype(np.float64).copy()
    rounds = 0
    while True:
        open_ = np.flatnonzero((mass > 0) & (mass < size))
        first = np.flatnonzero(np.diff(group[open_], prepend=-1) != 0)
        rank = np.arange(len(open_)) - np.repeat(first, np.diff(np.append(first, len(open_))))
        left = np.flatnonzero((rank % 2 == 0)[:-1] & (rank[1:] > rank[:-1])) if len(open_) > 1 else []
        if not len(left):
            return mass
        i, j = open_[left], open_[np.asarray(left) + 1]
        up = np.minimum(size[i] - mass[i], mass[j])      # words j can give to i
        down = np.minimum(mass[i], size[j] - mass[j])    # words i can give to j
        with np.errstate(over="ignore"):
            u = _mix(draw[i] * np.uint64(3) + draw[j] + np.uint64(rounds)) / 2.0 ** 64
        gives = u < down / (up + down)
        full = size[i] - mass[i] <= mass[j]
        spent = mass[i] <= size[j] - mass[j]
        total = mass[i] + mass[j]
        new_i = np.where(gives, np.where(full, size[i], total), np.where(spent, 0.0, total - size[j]))
        new_j = np.where(gives, np.where(full, total - size[i], 0.0), np.where(spent, total, size[j]))
        mass[i], mass[j] = new_i, new_j
        rounds += 1


def _level(bucket: pa.Table) -> pa.Table:
    """One bucket of the tree: rounds what can be paired in it."""
    keys = ["source_key", "node", "draw", "size", "mass"]
    frame = bucket.select(keys).to_pandas().sort_values(keys, kind="stable")
    group = pd.factorize(pd.MultiIndex.from_frame(frame[["source_key", "node"]]))[0]
    mass = np.empty(len(frame))
    mass[frame.index] = pivotal(group, frame["size"].to_numpy(np.float64), frame["mass"].to_numpy(np.float64),
                                frame["draw"].to_numpy(np.int64).view(np.uint64))
    return bucket.set_column(bucket.schema.get_field_index("mass"), "mass", pa.array(mass))


def _open():
    return (F.col("mass") > 0) & (F.col("mass") < F.col("size"))


def _row_hash(docs: DataFrame) -> Column:
    """A hash of all columns, of any type."""
    return F.xxhash64(F.lit(SEED), *[
        F.col(f"`{f.name}`") if "map<" not in f.dataType.simpleString() else F.to_json(F.struct(F.col(f"`{f.name}`")))
        for f in docs.schema.fields])


def mix(docs: DataFrame, source: str = "source", size: str | None = None,
        text: str = "text", weights: Sequence[float] = WEIGHTS, share: float = SHARE,
        ceiling: float = CEILING, bucket_rows: int = BUCKET_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """``(row, size, source, source_size, target, copies, taken)``: ``row`` is
    the input row, ``copies`` how often the mix takes it. ``size`` names a
    column of word counts; without it the words of ``text`` are counted."""
    scratch = Scratch(docs.sparkSession, "mix")
    # Equal rows get draws of their own by a repeat number, so a hot id is dealt like any other rows.
    sized = scratch.table(docs.select(
        pack(docs).alias("row"), F.col(source).alias("source"), _row_hash(docs).alias("draw"),
        (F.col(size).cast("long") if size else word_count(text)).alias("size"))
        .withColumn("rid", F.monotonically_increasing_id()), "sized")
    wanted = scratch.table(targets(sized.select("source", "size"), scratch, weights, share, ceiling)
                           .withColumnRenamed("source", "target_source"), "targets")
    at_source = F.col("source").eqNullSafe(F.col("target_source"))
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    numbered = prefix_sum(sized.select("rid", "source", "size", "draw", F.lit(1).alias("one")), ["rid"], ["draw"], "one",
                          name="repeat")
    n_rows = sized.count()
    nodes = max(1, math.ceil(n_rows / bucket_rows))
    # Only these thin rows go through the tree.
    rows = (numbered.join(wanted, at_source)
            .withColumn("draw", F.when(F.col("repeat") == 0, F.col("draw")).otherwise(F.xxhash64("draw", "repeat")))
            .select("rid", F.xxhash64("source", F.col("source").isNull()).alias("source_key"), "draw", "size",
                    F.when(F.col("size") > 0, (times - F.floor(times)) * F.col("size")).otherwise(0.0).alias("mass"),
                    F.pmod("draw", F.lit(nodes)).alias("node"), F.pmod("draw", F.lit(nodes)).alias("bucket")))
    settled, k = [], 0
    while True:
        done = scratch.table(rows.groupBy("bucket").applyInArrow(_level, rows.schema), f"level-{k}")
        settled.append(done.where(~_open()))
        left = done.where(_open())
        if nodes == 1:
            break
        nodes, k = math.ceil(nodes / fan_in), k + 1
        n_open = left.count()
        n_buckets = max(1, math.ceil(n_open / bucket_rows))
        rows = (left.withColumn("node", F.expr(f"node div {fan_in}"))
                .withColumn("bucket", F.pmod(F.xxhash64("source_key", "node"), F.lit(n_buckets))))
    chance = F.pmod(F.xxhash64(F.col("draw"), F.lit(SEED)), F.lit(1 << 53)) / float(1 << 53)
    settled.append(left.withColumn("mass", F.when(chance * F.col("size") < F.col("mass"),
                                                  F.col("size").cast("double")).otherwise(0.0)))
    taken = settled[0].select(F.col("rid").alias("of"), "mass")
    for part in settled[1:]:
        taken = taken.unionByName(part.select(F.col("rid").alias("of"), "mass"))
    copies = F.floor(times) + F.when((F.col("size") > 0) & (F.col("mass") >= F.col("size")), 1).otherwise(0)
    out = (sized.join(taken, F.col("rid") == F.col("of")).join(wanted, at_source)
           .select("row", "size", "source", "source_size", "target", copies.cast("long").alias("copies")))
    return scratch.result(out.withColumn("taken", F.col("copies") * F.col("size")))
