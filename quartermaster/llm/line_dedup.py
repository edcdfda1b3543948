"""Line dedup by site-relative frequency (DataFrame operations only).

A line is boilerplate of its host when the share of the host's pages that
contain it exceeds ``ratio``. Both sides of the division are exact counts
over all pages.

Why it holds at scale:

* Lines are counted as ``(host, 64-bit hash)`` once per page, with partial
  counts in every task, so a line that stands on a third of all pages is one
  partial row per task. A wrong drop needs a hash collision between a line
  and one of the few boilerplate lines of its own host.
* The boilerplate of one host fits one array: the shares of a host's lines
  add up to its mean number of distinct lines per page, so at most
  ``mean / ratio`` lines can exceed ``ratio``.
* The text moves only if Spark finds the boilerplate table (written first, so
  its size is known) too large to broadcast. Then the join key carries a salt
  and a host with a third of all pages is spread over ``salts`` tasks.

Defined results: lines are compared after trimming ASCII blanks; blank lines
are neither counted nor dropped; null and empty texts stay as they are; pages
without a host form one host; every row is a page, repeated rows included;
a page whose lines all go keeps its row with an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, pack

RATIO = 0.1
MIN_PAGES = 5
BLANKS = " \t\x0b\x0c\r"


def _trim(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(pages: DataFrame, host: str, text: str, ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, line, n_pages, n_host_pages)``: the hash of every boilerplate
    line with the two counts its ratio is made of."""
    trimmed = F.filter(F.transform(_lines(F.col(text)), _trim), lambda x: x != "")
    keys = F.array_distinct(F.transform(trimmed, lambda x: F.xxhash64(x)))
    per_line = (pages.select(F.col(host).alias("host"), F.explode(keys).alias("line"))
                .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_pages"))
                .where(F.col("n_pages") >= min_pages))
    totals = (pages.groupBy(F.col(host).alias("total_host"))
              .agg(F.count(F.lit(1)).alias("n_host_pages")))
    return (per_line.join(totals, F.col("host").eqNullSafe(F.col("total_host")))
            .where(F.col("n_pages").cast("double") > F.lit(float(ratio)) * F.col("n_host_pages"))
            .select("host", "line", "n_pages", "n_host_pages"))


def line_dedup(docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
               min_pages: int = MIN_PAGES, salts: int = 16) -> DataFrame:
    """``(row, kept_text, n_lines, n_dropped)``: ``row`` is the input row as a
    struct; ``kept_text`` its text without the boilerplate of its host."""
    spark = docs.sparkSession
    found = boilerplate(docs, host, text, ratio, min_pages)
    per_host = Scratch(spark, "line-dedup").table(
        found.groupBy("host").agg(F.array_sort(F.collect_list("line")).alias("lines")), "hosts")
    per_host = per_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    rows = docs.select(pack(docs).alias("row"), F.col(host).alias("page_host"),
                       F.col(text).alias("page_text"),
                       F.pmod(F.xxhash64(F.col(text)), F.lit(salts)).cast("int").alias("page_salt"))
    joined = rows.join(per_host, F.col("page_host").eqNullSafe(F.col("host"))
                       & (F.col("page_salt") == F.col("salt")), "left")
    lines = _lines(F.col("page_text"))
    kept = F.filter(lines, lambda x: (_trim(x) == "")
                    | ~F.array_contains(F.col("lines"), F.xxhash64(_trim(x))))
    kept = F.when(F.col("lines").isNull(), lines).otherwise(kept)
    out = joined.select("row", "page_text", F.coalesce(F.size(lines), F.lit(0)).alias("all_lines"),
                        kept.alias("kept"))
    return out.select("row", F.array_join("kept", "\n").alias("kept_text"),
                      F.when(F.col("page_text").isNull(), 0).otherwise(F.col("all_lines"))
                      .cast("long").alias("n_lines"),
                      F.when(F.col("page_text").isNull(), 0)
                      .otherwise(F.col("all_lines") - F.size("kept")).cast("long").alias("n_dropped"))
