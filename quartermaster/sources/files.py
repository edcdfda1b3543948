"""Scans and sources S1-S5."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import base_name, field, glob_to_regex
from ..session import scratch_dir

# Literal relations are broadcast by hint; their size is known when built.
MAX_INLINE_ROWS = 100_000


def file_inventory(spark: SparkSession, root: str, exclude_names: Sequence[str] = ()) -> DataFrame:
    """Every file under ``root`` at any depth as ``(path, name, length,
    modified)``, minus files whose base name is excluded (at every depth).

    ``binaryFile`` lists in parallel and, because ``content`` is never
    selected, never reads file bytes. Like every Spark file source it skips
    names starting with ``_`` or ``.``; ``file_inventory_all`` lists those too.
    """
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
          .select("path", base_name("path").alias("name"),
                  F.col("length").cast("long").alias("length"),
                  F.col("modificationTime").alias("modified")))
    if exclude_names:
        df = df.filter(~F.col("name").isin(list(exclude_names)))
    return df


def subfolders(spark: SparkSession, root: str, glob: str = "*") -> list[str]:
    """Names of the folders directly in ``root`` that match a glob, sorted."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{glob}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(f.getPath().getName() for f in found if f.isDirectory())


LISTED = "path string, name string, length long, modified timestamp, folder boolean"


def _store(uri: str) -> tuple[pafs.FileSystem, str, str]:
    """(file system, path in it, what stands in front of such paths in a URI)."""
    local = re.fullmatch(r"(?:file:/*(?=/))?(/.*)", uri)
    if local:
        return pafs.LocalFileSystem(), local[1], "file:"
    scheme, authority, rest = re.fullmatch(r"([^:/]+)://([^/]*)(.*)", uri).groups()
    store, base = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
    base = base.rstrip("/")  # a bucket, or nothing
    return store, base + rest, f"{scheme}://{authority}"[:len(f"{scheme}://{authority}") - len(base)]


def _list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The direct children of each folder. Links are not followed."""
    for batch in batches:
        rows = []
        for uri in batch.column(0).to_pylist():
            store, at, front = _store(uri)
            for f in store.get_file_info(pafs.FileSelector(at)):
                if isinstance(store, pafs.LocalFileSystem) and os.path.islink(f.path):
                    continue
                folder = f.type == pafs.FileType.Directory
                rows.append((front + f.path, f.base_name, 0 if folder else f.size, f.mtime, folder))
        cols = list(zip(*rows)) or [()] * 5
        types = (pa.string(), pa.string(), pa.int64(), pa.timestamp("us", tz="UTC"), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                         names=["path", "name", "length", "modified", "folder"])


def file_inventory_all(spark: SparkSession, root: str, exclude_names: Sequence[str] = ()) -> DataFrame:
    """S1 with every file, as ``find -type f`` lists them: also names that start
    with ``_`` or ``.``, which Spark's own file listing skips, and files in such
    folders.

    One round per level of the tree: the folders of a level are dealt evenly to
    the tasks, which list them; files stay in the shared scratch folder, the
    folders found are the next level. So a level with many folders is listed by
    the whole cluster and the driver never holds a name. Links are not followed.
    Tasks list through Arrow's file systems (local, S3, GCS, HDFS), so they need
    the access rights there that Spark has."""
    out = scratch_dir(spark, "inventory")
    level, n, k = spark.createDataFrame([(root.rstrip("/") or "/",)], "path string"), 1, 0
    while n:
        at = f"{out}/level={k}"
        tasks = min(n, 4 * spark.sparkContext.defaultParallelism)
        level.repartition(tasks).mapInArrow(_list_folders, LISTED).write.mode("overwrite").parquet(at)
        level, k = spark.read.schema(LISTED).parquet(at).where("folder").select("path"), k + 1
        n = level.count()
    files = (spark.read.schema(f"{LISTED}, level int").parquet(out).where("not folder")
             .select("path", "name", "length", "modified"))
    if exclude_names:
        files = files.filter(~F.col("name").isin(list(exclude_names)))
    return files


def glob_scan(spark: SparkSession, root: str, glob: str, fmt: str = "binaryFile",
              content: bool = False) -> DataFrame:
    """Files directly in ``root`` whose name matches a glob such as
    ``[Gg]*`` or ``*.nupkg``. No recursion, like the shell glob."""
    df = spark.read.format(fmt).option("pathGlobFilter", glob).load(root)
    if fmt == "binaryFile":
        cols = ["path", base_name("path").alias("name"), F.col("length").cast("long").alias("length")]
        if content:
            cols.append("content")
        df = df.select(*cols)
    return df


def glob_filter(df: DataFrame, col: str, glob: str, on_base_name: bool = True) -> DataFrame:
    """S2 on a name column: keep rows whose (base) name matches the glob."""
    c = base_name(col) if on_base_name else F.col(col)
    return df.filter(c.rlike(glob_to_regex(glob)))


def split_lines(df: DataFrame, col: str, sep: str, names: Sequence[str]) -> DataFrame:
    """S3 on a text column: field i of ``col`` into ``names[i]``. A short
    line gives empty fields instead of failing."""
    return df.select("*", *[field(col, sep, i + 1).alias(n) for i, n in enumerate(names)])


def line_scan(spark: SparkSession, path: str, sep: str, names: Sequence[str]) -> DataFrame:
    """S3: read a listing line by line and split every line."""
    return split_lines(spark.read.text(path), "value", sep, names).drop("value")


def line_scan_numbered(spark: SparkSession, path: str, sep: str, names: Sequence[str],
                       line: str = "line") -> DataFrame:
    """S3 with the file and the exact 1-based number of every line, as
    ``(path, line, names...)``, however many splits a file is read in.

    The lines of a split are numbered in the task that reads them; the first
    line of a split follows from the line counts of the splits before it, a
    table of one row per split. Both scans are of one file index, so they are
    cut alike. The lines are not sorted and not put through a window."""
    rows = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("__qm_start"),
        F.monotonically_increasing_id().alias("__qm_id"))
    splits = rows.groupBy("path", "__qm_start").agg(F.count(F.lit(1)).alias("n"), F.min("__qm_id").alias("__qm_first"))
    before = Window.partitionBy("path").orderBy("__qm_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("path", "__qm_start", (
        F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("__qm_first") + 1).alias("__qm_offset"))
    numbered = rows.join(offsets, ["path", "__qm_start"]).withColumn(line, F.col("__qm_offset") + F.col("__qm_id"))
    return split_lines(numbered, "value", sep, names).select("path", line, *names)


PIECE = 1 << 20  # bytes of a file held at once


def _digest_files(bits: int):
    """(path, length, digest) of each path, read piece by piece. A second
    column lists the parts to read for it, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            paths = batch.column(0).to_pylist()
            parts_of = batch.column(1).to_pylist() if batch.num_columns > 1 else [[p] for p in paths]
            for path, parts in zip(paths, parts_of):
                sha, length = hashlib.new(f"sha{bits}"), 0
                for uri in parts:
                    store, at, _ = _store(uri)
                    with store.open_input_stream(at, compression=None, buffer_size=0) as file:
                        while piece := file.read(PIECE):
                            sha.update(piece)
                            length += len(piece)
                rows.append((path, length, sha.hexdigest()))
            cols = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string()))],
                                             names=["path", "length", "digest"])

    return run


def file_digests(files: DataFrame, bits: int = 256, path: str = "path") -> DataFrame:
    """H1 for whole files of any size: ``(path, name, length, digest)`` of the
    files of an inventory. A file is read in pieces of 1 MB by one task (a
    ``binaryFile`` row holds a whole file, 2 GB at most); the files are dealt
    evenly, whatever folder they lie in."""
    n = min(4 * files.sparkSession.sparkContext.defaultParallelism, max(1, files.count()))
    return (files.select(F.col(path).alias("path")).repartition(n)
            .mapInArrow(_digest_files(bits), "path string, length long, digest string")
            .select("path", base_name("path").alias("name"), "length", "digest"))


def folder_digests(files: DataFrame, bits: int = 256, path: str = "path") -> DataFrame:
    """H1 for files written in parts: ``(path, name, length, digest)`` of each
    folder of an inventory, as of its files one after the other in the order
    of their names (Spark's writers number the parts in row order). Any number
    of tasks can write such a file. A digest is one chain over all bytes, so
    one task reads the parts of a folder, in pieces of 1 MB."""
    folder = F.regexp_extract(path, "^(.*)/[^/]*$", 1)
    parts = files.groupBy(folder.alias("path")).agg(F.array_sort(F.collect_list(path)).alias("parts"))
    n = min(4 * files.sparkSession.sparkContext.defaultParallelism, max(1, parts.count()))
    return (parts.repartition(n).mapInArrow(_digest_files(bits), "path string, length long, digest string")
            .select("path", base_name("path").alias("name"), "length", "digest"))


def layout_scan(spark: SparkSession, root: str, schema: StructType | str | None = None,
                **partition_values) -> DataFrame:
    """Read a ``key=value`` partitioned layout, keeping only the given
    partition values. The filter is on partition columns, so Spark prunes
    whole folders before listing files (``PartitionFilters`` in the plan).
    Give a ``schema`` to fix the types of the partition values; without one
    Spark guesses them, and a folder ``arch=001`` reads back as the number 1."""
    df = spark.read.schema(schema).parquet(root) if schema is not None else spark.read.parquet(root)
    for k, v in partition_values.items():
        df = df.filter(F.col(k).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(k) == v)
    return df


def inline_relation(spark: SparkSession, rows: Sequence, schema: StructType | str) -> DataFrame:
    """A literal table (maps and lists written in code). Its size is
    known here, so it is checked and hinted for broadcast."""
    if len(rows) > MAX_INLINE_ROWS:
        raise ValueError(f"inline relation has {len(rows)} rows; load it as a table")
    return F.broadcast(spark.createDataFrame(list(rows), schema))
