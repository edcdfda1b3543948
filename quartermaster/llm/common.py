"""Helpers shared by the training-data operators.

Conventions of this subpackage:

* The caller's row travels as one struct column (``row``), so an extra
  column can never clash with a column an operator adds.
* A document's identity inside an operator is ``(doc_id, xxhash64(text))``
  (:func:`doc_key`). What an operator decides depends on the text alone, so
  repeated rows share one decision and a null ``doc_id`` is a value like any
  other.
* Intermediate tables are written to the shared folder the cluster names in
  ``spark.checkpoint.dir`` (:class:`Scratch`). A lost executor therefore
  costs the tasks of one stage only. They are deleted as soon as the
  operator's own result is written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

# Word patterns of the contracts (fixed values).
SPACE_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, UPPER, UPPER.lower())


def pack(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct column."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def doc_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """``(k_id, k_null, k_hash)``, never null: equal for equal (doc_id, text).
    ``doc_id`` holds whole numbers; text that isn't one fails the job."""
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("k_id"),
            F.col(doc_id).isNull().alias("k_null"),
            F.xxhash64(F.col(text)).alias("k_hash")]


KEY = ["k_id", "k_null", "k_hash"]


def key_id() -> Column:
    """The ``doc_id`` a document key was made of."""
    return F.when(~F.col("k_null"), F.col("k_id"))


def slices(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of whole rows whose sizes add up to about ``most``."""
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes.astype(np.int64)) // most)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield batch.slice(lo, hi - lo)


class Scratch:
    """Tables of one operator call in the shared folder.

    ``table`` writes a frame and reads it back (lineage ends there).
    ``result`` does the same outside the folder that ``drop`` removes, so
    the intermediates can go at once while the result stays readable.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_dir(spark, label)
        self.kept = scratch_dir(spark, f"{label}-result")

    def _write(self, df: DataFrame, path: str) -> DataFrame:
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        return self._write(df, f"{self.root}/{name}")

    def result(self, df: DataFrame) -> DataFrame:
        out = self._write(df, self.kept)
        self.drop()
        return out

    def drop(self) -> None:
        self._delete(self.root)

    def drop_result(self) -> None:
        """Removes the result as well, once nothing reads it any more."""
        self._delete(self.kept)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
