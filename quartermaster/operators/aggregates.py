"""Aggregations A1-A5 and exact ordinals.

All aggregates here are distributive (count, sum, max, max_by), so Spark
runs them partially in every task before the shuffle: a group holding a
third of all rows is one partial row per map task. Nothing collects a group
into one row; ordered lists are kept as long tables with exact positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


# ---------------------------------------------------------------- A1

def distinct_selection(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """A1: the set of requested values (no order)."""
    return df.select(*_cols(cols)).dropDuplicates()


# ---------------------------------------------------------------- ordinals

def _ranged(df: DataFrame, keys: Sequence[str], num_partitions: int | None) -> tuple[DataFrame, Column]:
    """``df`` cut into sorted ranges of ``keys``, with ``__qm_id`` (range and
    place in it), and the range's number. Checkpointed once: the ranges come
    from a sample, so they must not be drawn again. The input is persisted in
    the meantime, so that sampling does not evaluate it a second time (a lost
    block is computed again; the sample only sets the cuts)."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) for c in keys]
    ours = df.storageLevel == StorageLevel.NONE
    if ours:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                 .withColumn("__qm_id", F.monotonically_increasing_id()).checkpoint(eager=True))
    finally:
        if ours:
            df.unpersist()
    return out, F.shiftright("__qm_id", 33)


def _free_name(df: DataFrame, name: str) -> None:
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the input has a column {name} already; pass another name")


def ordinal(df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = (),
            name: str = "position", num_partitions: int | None = None) -> DataFrame:
    """Exact 1-based position of each row within ``partition_by`` (or over
    the whole frame) in ``order_by`` order, without putting a group into
    one task. Null keys are a group like any other.

    1. The input is range-partitioned on ``partition_by + order_by``, sorted
       inside the ranges and checkpointed once: one shuffle of the rows, and a
       big group is cut into many ranges. The low 33 bits of
       ``monotonically_increasing_id`` are the place within the range.
    2. Per (range, group): the first place and the row count. A running sum
       of the counts over the ranges of a group gives its offset; that table
       has at most (#groups + #ranges) rows and is joined back null-safe.
    ``order_by`` should be unique within a group: equal sort keys cannot be
    split across ranges. ``name`` must be free.
    """
    part, order = list(partition_by), list(order_by)
    _free_name(df, name)
    ranged, pid = _ranged(df, part + order, num_partitions)
    place = F.col("__qm_id").bitwiseAND(F.lit((1 << 33) - 1))
    counts = (ranged.groupBy(pid.alias("__qm_pid"), *[F.col(c).alias(f"__qm_{c}") for c in part])
              .agg(F.count(F.lit(1)).alias("__qm_cnt"), F.min(place).alias("__qm_first")))
    groups = [f"__qm_{c}" for c in part]
    before = Window.partitionBy(*groups).orderBy("__qm_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__qm_pid", *groups, (
        F.coalesce(F.sum("__qm_cnt").over(before), F.lit(0)) - F.col("__qm_first") + 1).alias("__qm_off"))
    if not part:  # one row per range
        offsets = F.broadcast(offsets)
    same = pid == F.col("__qm_pid")
    for c in part:
        same = same & F.col(c).eqNullSafe(F.col(f"__qm_{c}"))
    return (ranged.join(offsets, same).withColumn(name, F.col("__qm_off") + place)
                  .select(*df.columns, name))


def prefix_sum(df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str], value: str,
               name: str = "offset", num_partitions: int | None = None) -> DataFrame:
    """Sum of ``value`` over the rows before each row of its group, in
    ``order_by`` order: 0 for the first. Nulls count as 0; null keys are a group.

    The rows are cut into sorted ranges (as in :func:`ordinal`), so a hot group
    lies in many of them. Sums per (range, group) and a running sum over the
    ranges of a group give what every range starts with. That carry enters as
    one more row in front of the range's rows, and one window per (range,
    group) adds up. No window sees more than a range, and the rows are not
    joined. Pass thin rows: they are shuffled twice. ``order_by`` should be
    unique within a group; ``name`` must be free."""
    part = list(partition_by)
    _free_name(df, name)
    ranged, pid = _ranged(df, part + list(order_by), num_partitions)
    ranged = ranged.withColumn("__qm_pid", pid).withColumn("__qm_value", F.coalesce(F.col(value).cast("long"), F.lit(0)))
    sums = ranged.groupBy("__qm_pid", *part).agg(F.sum("__qm_value").alias("__qm_value"))
    before = Window.partitionBy(*part).orderBy("__qm_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select("__qm_pid", *part, F.coalesce(F.sum("__qm_value").over(before), F.lit(0)).alias("__qm_value"),
                        F.lit(-1).cast("long").alias("__qm_id"))
    both = ranged.unionByName(carry, allowMissingColumns=True)
    inside = Window.partitionBy("__qm_pid", *part).orderBy("__qm_id").rowsBetween(Window.unboundedPreceding, -1)
    return (both.withColumn(name, F.sum("__qm_value").over(inside)).where("__qm_id >= 0")
                .select(*df.columns, name))


# ---------------------------------------------------------------- A2

def bundle_summary(df: DataFrame, bundle: str, size: str | Column) -> DataFrame:
    """A2: one row per bundle: member count and total bytes. Only
    fixed-width counters, so it is a hash aggregate, partial in every task
    before the shuffle. The members themselves, in order, are
    ``bundle_members``."""
    sz = F.col(size) if isinstance(size, str) else size
    return (df.groupBy(bundle)
              .agg(F.count(F.lit(1)).alias("n_members"),
                   F.sum(sz.cast("long")).alias("total_bytes")))


def bundle_members(df: DataFrame, bundle: str, member: str) -> DataFrame:
    """A2: the members of each bundle in repeatable (byte) order, as
    ``(bundle, position, member)`` rows."""
    m = df.select(F.col(bundle), F.col(member).cast("string").alias(member))
    return ordinal(m, [member], [bundle]).select(bundle, "position", member)


def bundle_offsets(df: DataFrame, bundle: str, member: str, size: str | Column) -> DataFrame:
    """A2: where each member lies in its bundle, members in byte order one
    behind the other, as ``(bundle, member, offset, length)`` rows. A null
    length is 0. Members of equal name lie behind each other in any order."""
    sz = F.col(size) if isinstance(size, str) else size
    m = df.select(F.col(bundle), F.col(member).cast("string").alias(member),
                  F.coalesce(sz.cast("long"), F.lit(0)).alias("length"))
    return prefix_sum(m, [member], [bundle], "length").select(bundle, member, "offset", "length")


# ---------------------------------------------------------------- A3

def nonempty_guard(df: DataFrame, message: str = "nothing to publish") -> DataFrame:
    """A3, in-plan form: ``(n)`` with the row count; the job fails with
    ``message`` when it is zero. Count is partial per task."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("n")).select(
        F.when(F.col("n") > 0, F.col("n")).otherwise(F.raise_error(F.lit(message))).alias("n"))


def require_nonempty(df: DataFrame, message: str = "nothing to publish") -> DataFrame:
    """A3, driver form: stop before any write when ``df`` has no row.
    ``isEmpty`` reads at most one row."""
    if df.isEmpty():
        raise RuntimeError(message)
    return df


# ---------------------------------------------------------------- A4

def collect_args(df: DataFrame, key: str | Sequence[str], seq: str, value: str) -> DataFrame:
    """A4: repeated arguments in the order given, repeats kept, as
    ``(key..., position, value)``. ``seq`` orders the arguments within a key."""
    ks = _cols(key)
    out = ordinal(df.select(*ks, seq, value), [seq], ks)
    return out.select(*ks, "position", value)


def args_count(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """A4 companion: number of arguments per key."""
    return df.groupBy(*_cols(key)).agg(F.count(F.lit(1)).alias("n_args"))


# ---------------------------------------------------------------- A5

def resolve_layers(df: DataFrame, key: str | Sequence[str], layer: str, seq: str,
                   value: str, out: str = "value") -> DataFrame:
    """A5: per key, the value of the highest (layer, seq): a flag beats the
    file default and the last repeat wins. An empty or null winning value
    still wins (it is not skipped). Nulls order
    lowest, in ``layer`` as in ``seq``, whatever the column types. ``max_by``
    over a struct is partial in every task before the shuffle."""
    ks = _cols(key)
    order = F.struct(F.col(layer), F.col(seq))
    return (df.groupBy(*ks)
              .agg(F.max_by(F.col(value), order).alias(out),
                   F.max(layer).alias("winning_layer")))
