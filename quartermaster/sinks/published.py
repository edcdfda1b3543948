"""Publishing only new keys against a key index.

Beside a target lies an index of the keys published so far: keys only, in
Parquet files that Spark buckets by key. Finding out which keys of a batch are
known never opens a file of the target, and the index is joined bucket by
bucket without being shuffled.

Layout (all in shared folders)::

    <target>/publish=<n>/...          rows of publish n
    <index>/_buckets_<b>              number of buckets, fixed for good
    <index>/segments/publish=<n>/...  keys of publish n, bucketed
    <index>/_log/<n>.<writer>         publish n is committed
    <index>/_log/compact-<g>.<n>      segment -g holds the keys of publishes up to n

A publish writes its rows, then its keys, then the log entry. One that dies
before the entry has published nothing: the next one takes the same number and
overwrites both folders. A log entry is one empty file, so it is there or not.
One writer per target, as for any plain Parquet folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
PUBLISH = "publish"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _files(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the files that match a glob."""
    fs, p = _fs(spark, pattern)
    return sorted(f.getPath().getName() for f in fs.globStatus(p) or [])


def _touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    fs.create(p, True).close()


# What a null key is stored as, beside its null flag: joins on plain equality.
def _stand_in(kind: T.DataType) -> Column:
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return F.lit(0).cast(kind)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.lit("").cast(kind)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(kind)
    raise ValueError(f"a key of type {kind.simpleString()} can't be indexed")


class KeyIndex:
    """The keys published so far. ``fields`` are the key columns with types."""

    def __init__(self, spark: SparkSession, path: str, fields: Sequence[T.StructField], buckets: int = BUCKETS):
        self.spark, self.path, self.fields = spark, path.rstrip("/"), list(fields)
        made = [int(n.rsplit("_", 1)[1]) for n in _files(spark, f"{self.path}/_buckets_*")]
        if not made:
            _touch(spark, f"{self.path}/_buckets_{buckets}")
            made = [buckets]
        if made != [buckets]:
            raise ValueError(f"{path} has {made[0]} buckets, not {buckets}")
        self.buckets = buckets
        self.columns = [f"{kind}{k}" for k in range(len(self.fields)) for kind in ("none_", "key_")]
        self.dealt_by = [f"key_{k}" for k in range(len(self.fields))]

    # -- log

    def log(self) -> dict[int, str]:
        """Committed publishes and who wrote them."""
        out = {}
        for name in _files(self.spark, f"{self.path}/_log/*"):
            if not name.startswith("compact-"):
                n, writer = name.split(".", 1)
                out[int(n)] = writer
        return out

    def _compacted(self) -> tuple[int, int]:
        """(generation, last publish in it) of the newest compaction; (0, -1)."""
        found = [n[len("compact-"):].split(".") for n in _files(self.spark, f"{self.path}/_log/compact-*")]
        return max(((int(g), int(n)) for g, n in found), default=(0, -1))

    def last(self) -> int:
        """The newest committed publish; -1 if there is none."""
        return max([*self.log(), self._compacted()[1]])

    def commit(self, number: int, writer: str) -> None:
        _touch(self.spark, f"{self.path}/_log/{number:012d}.{writer}")

    # -- keys

    def encode(self, df: DataFrame, names: Sequence[str]) -> DataFrame:
        """The index columns of the key columns ``names`` of ``df`` (one row per
        key), dealt to the buckets."""
        cols = []
        for k, (c, f) in enumerate(zip(names, self.fields)):
            cols += [F.col(f"`{c}`").isNull().alias(f"none_{k}"),
                     F.coalesce(F.col(f"`{c}`"), _stand_in(f.dataType)).alias(f"key_{k}")]
        return df.select(*cols).repartition(self.buckets, *self.dealt_by)

    def _schema(self) -> str:
        return ", ".join(f"none_{k} boolean, key_{k} {f.dataType.simpleString()}" for k, f in enumerate(self.fields))

    def _segment(self, number: int) -> str:
        return f"{self.path}/segments/{PUBLISH}={number}"

    def add(self, keys: DataFrame, number: int) -> None:
        """Writes encoded keys as a segment: one file per bucket."""
        name = f"key_segment_{uuid.uuid4().hex}"
        try:
            (keys.write.mode("overwrite").format("parquet")
             .bucketBy(self.buckets, *self.dealt_by).option("path", self._segment(number)).saveAsTable(name))
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay

    def _parts(self, upto: int | None = None) -> list[int]:
        """Numbers of the segments that hold the committed keys."""
        generation, done = self._compacted()
        if upto is not None and done > upto:
            raise ValueError(f"publishes up to {done} are compacted; {upto} can't be read alone")
        parts = [n for n in sorted(self.log()) if n > done and (upto is None or n <= upto)]
        return [-generation, *parts] if generation else parts

    def keys(self, upto: int | None = None) -> DataFrame | None:
        """The keys of the committed publishes (up to one of them), as a bucketed
        scan; None if there are none."""
        parts = self._parts(upto)
        if not parts:
            return None
        name = f"key_index_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} ({self._schema()}, {PUBLISH} bigint) USING parquet PARTITIONED BY ({PUBLISH}) "
            f"CLUSTERED BY ({', '.join(self.dealt_by)}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/segments'")
        committed = " ".join(f"PARTITION ({PUBLISH}={n}) LOCATION '{self._segment(n)}'" for n in parts)
        self.spark.sql(f"ALTER TABLE {name} ADD {committed}")
        return self.spark.table(name).select(*self.columns)

    def known(self, batch_keys: DataFrame, upto: int | None = None) -> DataFrame | None:
        """Those of the encoded ``batch_keys`` that the index holds; a key is in one
        segment only. The index is the streamed side: no exchange, no sort; the
        batch is dealt to its buckets and hashed there."""
        index = self.keys(upto)
        if index is None:
            return None
        batch = batch_keys.select([F.col(c).alias(f"batch_{c}") for c in self.columns])
        same = F.lit(True)
        for k in range(len(self.fields)):
            same = same & (F.col(f"key_{k}") == F.col(f"batch_key_{k}"))
            # The flags are equal. As an equality it would be a join key, which the buckets are not made by.
            same = same & (F.col(f"none_{k}") <= F.col(f"batch_none_{k}")) & (F.col(f"none_{k}") >= F.col(f"batch_none_{k}"))
        return index.join(batch.hint("shuffle_hash"), same, "left_semi")

    def compact(self) -> int:
        """Merges all committed segments into one (one file per bucket) and
        removes them. Returns the generation. A compaction that dies before its
        log entry is overwritten by the next."""
        generation, last, parts = self._compacted()[0] + 1, self.last(), self._parts()
        if not parts:
            return generation - 1
        keys = self.spark.read.schema(self._schema()).parquet(*[self._segment(n) for n in parts])
        self.add(keys.repartition(self.buckets, *self.dealt_by), -generation)
        _touch(self.spark, f"{self.path}/_log/compact-{generation}.{last}")
        fs, root = _fs(self.spark, f"{self.path}/segments")
        for name in _files(self.spark, f"{self.path}/segments/{PUBLISH}=*"):
            number = int(name.split("=")[1])
            if number != -generation and number <= last:
                fs.delete(root.suffix(f"/{name}"), True)
        return generation


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the least by ``order_by`` (nulls first), then by all
    columns in turn, so the same row for any order of the input."""
    order = [F.col(c) for c in order_by]
    for f in df.schema.fields:
        if f.name not in order_by:
            order.append(F.col(f"`{f.name}`") if _sortable(f.dataType) else F.to_json(F.struct(F.col(f"`{f.name}`"))))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return (df.groupBy(*[F.col(f"`{k}`").alias(f"__qm_k{i}") for i, k in enumerate(keys)])
              .agg(F.min_by(row, F.struct(*order)).alias("__qm_row")).select("__qm_row.*"))


def publish_indexed(df: DataFrame, target: str, keys: str | Sequence[str], index: str | None = None,
                    buckets: int = BUCKETS, order_by: Sequence[str] = (), fmt: str = "parquet",
                    number: int | None = None, writer: str = "batch", known_upto: int | None = None,
                    distinct_keys: bool = False) -> int | None:
    """K7 with a key index: publishes the rows whose key is new and returns the
    publish number. Of several rows of a key, :func:`one_per_key` decides. Null
    keys are keys. ``index`` is ``<target>.keys`` unless given.

    For streams: ``number`` names the publish; one that ``writer`` committed
    before is skipped (None is returned), one of another writer is an error.
    ``known_upto`` looks keys up in the publishes up to that number only, for a
    caller that keeps track of later ones itself; ``distinct_keys`` says that
    ``df`` has one row per key."""
    spark = df.sparkSession
    ks = [keys] if isinstance(keys, str) else list(keys)
    book = KeyIndex(spark, index or f"{target.rstrip('/')}.keys", [df.schema[k] for k in ks], buckets)
    if number is None:
        number = book.last() + 1
    elif number in (done := book.log()):
        if done[number] != writer:
            raise ValueError(f"publish {number} of {target} is committed by {done[number]}, not {writer}")
        return None
    path = f"{target.rstrip('/')}/{PUBLISH}={number}"
    fresh = (df if distinct_keys else one_per_key(df, ks, order_by)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        known = book.known(book.encode(fresh, ks), known_upto)
        if known is not None:
            for k, c in enumerate(ks):
                same_k = (F.col(f"`{c}`").eqNullSafe(F.when(~F.col(f"none_{k}"), F.col(f"key_{k}"))))
                same = same_k if k == 0 else same & same_k
            fresh.join(known, same, "left_anti").write.mode("overwrite").format(fmt).save(path)
        else:
            fresh.write.mode("overwrite").format(fmt).save(path)
    finally:
        fresh.unpersist()
    written = spark.read.schema(df.schema).format(fmt).load(path)
    book.add(book.encode(written, ks), number)
    book.commit(number, writer)
    return number


def read_published(spark: SparkSession, target: str, schema: T.StructType, index: str | None = None,
                   fmt: str = "parquet") -> DataFrame:
    """The rows of the committed publishes, with their number as ``publish``."""
    names = _files(spark, f"{index or target.rstrip('/') + '.keys'}/_log/*")
    done = [int(n.split(".")[0]) for n in names if not n.startswith("compact-")]
    paths = [f"{target.rstrip('/')}/{PUBLISH}={n}" for n in sorted(done)]
    with_number = T.StructType([*schema.fields, T.StructField(PUBLISH, T.LongType())])
    if not paths:
        return spark.createDataFrame([], with_number)
    return spark.read.schema(with_number).option("basePath", target).format(fmt).load(paths)
