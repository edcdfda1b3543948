"""Sinks K1-K7. Writes go through Spark's commit protocol: a failed or
retried task never leaves partial files in the target, and a job that
dies before commit leaves no ``_SUCCESS`` marker."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import default_if_empty


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system of ``path`` and the path in it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` (file or folder) exists. Any other trouble raises."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """One small file of text, replacing what is there."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def _load(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    """The rows at ``path``; None when nothing has been written there yet.
    A target that exists but can't be read raises."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # also raised for a folder without files
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            if files.select("path").isEmpty():
                return None
        raise


def is_complete(spark: SparkSession, path: str) -> bool:
    """A folder counts as written only when its ``_SUCCESS`` marker exists,
    so an interrupted write is not taken for a finished one."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def write_if_absent(df: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """K1: write only when no complete output exists; a half-written folder
    is overwritten. Returns True when it wrote."""
    if is_complete(df.sparkSession, path):
        return False
    df.write.mode("overwrite").format(fmt).save(path)
    return True


def write_replace(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """K2: replace whatever is at ``path``."""
    df.write.mode("overwrite").format(fmt).options(**options).save(path)


# The pointer file of a versioned folder; its one line names the version.
POINTER = "_current"


def write_versioned(df: DataFrame, path: str, fmt: str = "parquet", keep: int = 2, **options) -> str:
    """K2 without a gap: the rows go to a folder of their own below ``path``,
    then one rename switches the pointer file to it. Until then readers
    (:func:`read_versioned`) see the old rows, after it the new ones; a job that
    dies in between leaves the old rows readable. The ``keep`` newest complete
    versions stay, for readers that have just resolved the pointer. Returns the
    version's name."""
    spark = df.sparkSession
    root = path.rstrip("/")
    fs, folder = _fs(spark, root)
    version = f"v{(max([0, *_versions(spark, root)]) + 1):012d}"
    df.write.mode("overwrite").format(fmt).options(**options).save(f"{root}/{version}")
    replace_file(spark, f"{root}/{POINTER}", version)
    for old in sorted(_versions(spark, root))[:-max(1, keep)]:
        fs.delete(folder.suffix(f"/v{old:012d}"), True)
    return version


def _versions(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _fs(spark, root)
    found = fs.globStatus(folder.suffix("/v*")) or []
    return [int(f.getPath().getName()[1:]) for f in found]


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Replaces a small file at once: written beside, then renamed over it. A
    reader sees the old text or the new one."""
    jvm = spark._jvm
    beside = f"{path}.next"
    write_file(spark, beside, text)
    fs, target = _fs(spark, path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(_fs(spark, beside)[1]), fs.makeQualified(target), overwrite)


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    if not path_exists(spark, path):
        return None
    fs, p = _fs(spark, path)
    file = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
    finally:
        file.close()


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder the pointer names; None before the first version."""
    name = read_file(spark, f"{path.rstrip('/')}/{POINTER}")
    return None if name is None else f"{path.rstrip('/')}/{name.strip()}"


def read_versioned(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The rows of the current version."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"{path} has no version yet")
    return spark.read.format(fmt).load(version)


def write_append(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """K3: add to ``path``. Not idempotent: a rerun adds the rows again
    (use ``publish_new`` when reruns happen)."""
    df.write.mode("append").format(fmt).options(**options).save(path)


def layout_write(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet",
                 fill: dict[str, str] | None = None) -> None:
    """K4: write under ``key=value`` folders; only the partitions present in
    ``df`` are replaced (dynamic overwrite), so one target never wipes
    another. The ``rebalance`` hint clusters rows by the partition keys (few
    files per folder) and lets AQE split a partition value that holds a
    large share of the rows over several writers instead of one task.

    ``fill`` gives a folder value for rows where a level does not apply
    (null or empty), e.g. ``{"arch": "any"}`` for targets without an arch
    level, so the layout stays even."""
    for col, value in (fill or {}).items():
        df = df.withColumn(col, default_if_empty(F.col(col).cast("string"), value))
    (df.hint("rebalance", *partition_by)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).format(fmt).save(path))


def write_compressed(df: DataFrame, path: str, codec: str, fmt: str = "parquet") -> None:
    """K5: write with a compression codec (parquet: snappy, gzip, zstd, lz4,
    none; text/json/csv: gzip, bzip2, deflate, lz4, snappy)."""
    df.write.mode("overwrite").format(fmt).option("compression", codec).save(path)


@dataclass
class Sink:
    path: str
    fmt: str = "parquet"
    mode: str = "overwrite"
    options: dict = field(default_factory=dict)


def write_all(df: DataFrame, sinks: Sequence[Sink]) -> None:
    """Write ``df`` to every sink: the first one alone, so that a persisted
    ``df`` is complete before anyone else reads it (two jobs started together
    could both compute a block that neither has stored yet), then the others
    together, one driver thread each. The first failure is raised after all
    have finished."""
    def one(s: Sink) -> None:
        df.write.mode(s.mode).format(s.fmt).options(**s.options).save(s.path)

    for s in sinks[:1]:
        one(s)
    if len(sinks) > 1:
        with ThreadPoolExecutor(max_workers=len(sinks) - 1) as pool:
            futures = [pool.submit(one, s) for s in sinks[1:]]
        for f in futures:
            f.result()


def fan_out(df: DataFrame, sinks: Sequence[Sink]) -> None:
    """K6: the same rows to several sinks, computed once (persisted in
    memory and disk; a lost block is recomputed from lineage)."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_all(df, sinks)
    finally:
        df.unpersist()


# Partition column of a target written with ``key_buckets``.
KEY_BUCKET = "key_bucket"


def publish_new(df: DataFrame, target: str, keys: str | Sequence[str], fmt: str = "parquet",
                exclude_from_target: str | None = None, mode: str = "append",
                path: str | None = None, key_buckets: int | None = None) -> None:
    """K7: append only rows whose key is not at the target yet.

    The batch is de-duplicated on the key first (an anti join alone would
    let two copies of a new key in). The existing row wins; nothing is
    updated. Plain files have no lock: one writer per target.

    Null keys are keys: a row whose key is null is published once.

    Finding the keys already published: a left anti join can only broadcast
    its right side, which here is the ever-growing target. So the target's
    keys are first semi-joined against the batch's keys, which Spark
    broadcasts by itself when the persisted batch is small (the target is
    then scanned in place, without a shuffle); the anti join runs against
    the hits, never more rows than the batch has keys after de-duplication.

    ``key_buckets``: partition the target by ``pmod(xxhash64(keys), n)``, so a
    small batch reads only the buckets it touches (at most ``n`` ids, listed
    first). ``n`` is recorded with the target (``_key_buckets_<n>``); another
    number, or none, raises.

    ``exclude_from_target`` (a SQL predicate on the target, e.g. its own
    ``batch_id``) leaves out rows a retried stream batch wrote before it
    failed; ``path`` / ``mode`` let such a batch overwrite its own folder.
    """
    ks = [keys] if isinstance(keys, str) else list(keys)
    spark = df.sparkSession
    _check_buckets(spark, target, key_buckets)
    existing = _load(spark, target, fmt)
    fresh = df.dropDuplicates(ks)
    if key_buckets:
        fresh = fresh.withColumn(KEY_BUCKET, F.pmod(F.xxhash64(*ks), F.lit(key_buckets)).cast("int"))

    def write(out: DataFrame) -> None:
        if key_buckets:  # about one file per bucket; buckets of distinct keys are even
            out.hint("rebalance", KEY_BUCKET).write.mode(mode).format(fmt) \
               .partitionBy(KEY_BUCKET).save(path or target)
        else:
            out.write.mode(mode).format(fmt).save(path or target)

    if existing is None:
        write(fresh)
        return
    if exclude_from_target:
        existing = existing.filter(f"NOT ({exclude_from_target})")
    fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if key_buckets:
            touched = [r[0] for r in fresh.select(KEY_BUCKET).distinct().collect()]
            existing = existing.filter(F.col(KEY_BUCKET).isin(touched))
        batch_keys = fresh.select(*[F.col(k).alias(f"__qm_b_{k}") for k in ks])
        found = existing.select(*[F.col(k).alias(f"__qm_t_{k}") for k in ks])
        published = found.join(batch_keys, _same(ks, "__qm_t_", "__qm_b_"), "left_semi").dropDuplicates()
        write(fresh.join(published, _same(ks, "", "__qm_t_"), "left_anti"))
    finally:
        fresh.unpersist()


def _same(keys: Sequence[str], left: str, right: str):
    """Null-safe equality of two sets of key columns."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}{k}").eqNullSafe(F.col(f"{right}{k}"))
    return out


def _check_buckets(spark: SparkSession, target: str, key_buckets: int | None) -> None:
    """The number of key buckets a target was made with must not change."""
    fs, root = _fs(spark, target)
    path = spark._jvm.org.apache.hadoop.fs.Path
    found = fs.globStatus(path(root, "_key_buckets_*")) or []
    made_with = [int(f.getPath().getName().rsplit("_", 1)[1]) for f in found]
    if key_buckets and not made_with and not path_exists(spark, target):
        fs.mkdirs(root)
        fs.create(path(root, f"_key_buckets_{key_buckets}"), True).close()
    elif made_with != ([key_buckets] if key_buckets else []):
        raise ValueError(f"{target} has key buckets {made_with or None}, not {key_buckets}")
