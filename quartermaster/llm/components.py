"""Connected components of a link table.

Alternating large-star and small-star rounds: every round is two
aggregations and two equality joins, the number of rounds is logarithmic in
the longest chain, and the link table never grows. Each round is written to
the shared folder. Joins are plain shuffles, so AQE splits a node with very
many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"),
              F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``links(a, b)`` of longs to ``(node, root)`` for every node that is not
    the least of its component; ``root`` is that least node."""
    a, b = F.col("a"), F.col("b")
    e = scratch.table(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                      .distinct(), "links-0")
    before, k = _state(e), 0
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("mu"), F.least("u", "m").alias("m"))
        large = (both.join(least, F.col("u") == F.col("mu")).where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = scratch.table(large.distinct(), f"large-{k}")
        low = large.groupBy(F.col("u").alias("mu")).agg(F.min("v").alias("m"))
        small = (large.join(low, F.col("u") == F.col("mu")).where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        small = small.unionByName(low.select(F.col("mu").alias("u"), F.col("m").alias("v")))
        e, k = scratch.table(small.distinct(), f"links-{k + 1}"), k + 1
        now = _state(e)
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
