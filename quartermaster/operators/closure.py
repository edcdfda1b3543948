"""Dependency lists and their transitive closure."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def direct_edges(df: DataFrame, node: str, deps: str, sep: str = ",") -> DataFrame:
    """Expand ``node -> "a,b"`` into one ``(node, parent)`` row per entry
    (blank entries dropped)."""
    parents = F.transform(F.split(F.col(deps), re.escape(sep)), lambda x: F.trim(x))
    return (df.select(F.col(node).alias("node"), F.explode(parents).alias("parent"))
              .filter(F.col("parent") != ""))


def dependency_closure(edges: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """Every ``(node, ancestor)`` reachable over ``node -> parent`` edges,
    with ``depth`` = the shortest number of hops.

    Path doubling: round k joins the pairs exactly ``2**k`` hops apart to all
    pairs found so far (up to ``2**k`` hops) on the node in the middle and
    keeps the least depth per pair, so the number of rounds is the logarithm
    of the longest shortest path, at any size, and cycles end by themselves.
    All pairs are one frame, checkpointed to the shared folder each round: a
    lost executor costs one round, and the plan does not grow. The join is a
    plain equality join, so AQE splits the partitions of a hot ancestor.
    """
    pairs = (edges.select(F.col(node).alias("node"), F.col(parent).alias("ancestor"), F.lit(1).alias("depth"))
             .dropna().dropDuplicates().checkpoint(eager=True))
    hops = 1
    while True:
        far = pairs.filter(F.col("depth") == hops)
        if far.isEmpty():
            return pairs
        onward = pairs.select(F.col("node").alias("middle"), F.col("ancestor").alias("next"),
                              F.col("depth").alias("more"))
        longer = (far.join(onward, F.col("ancestor") == F.col("middle"))
                  .select("node", F.col("next").alias("ancestor"), (F.lit(hops) + F.col("more")).alias("depth")))
        pairs = (pairs.unionByName(longer).groupBy("node", "ancestor")
                 .agg(F.min("depth").alias("depth")).checkpoint(eager=True))
        hops *= 2


def cycles(closure: DataFrame) -> DataFrame:
    """``(node, cycle)`` of every node that depends on itself: ``cycle`` is the
    least node that it reaches and that reaches it (its strongly connected
    component). Two aggregations over the closure, no joins: the ancestors that
    are also descendants are the pairs found in both directions."""
    both = closure.select("node", "ancestor").unionByName(
        closure.select(F.col("ancestor").alias("node"), F.col("node").alias("ancestor")))
    mutual = both.groupBy("node", "ancestor").agg(F.count(F.lit(1)).alias("n"))
    # A pair from a node to itself stands twice; others twice if both ways hold.
    return mutual.where("n = 2").groupBy("node").agg(F.min("ancestor").alias("cycle"))


def dependency_order(nodes: DataFrame, closure: DataFrame, node: str = "node", on_cycle: str = "raise") -> DataFrame:
    """Dependencies first: nodes ordered by how many ancestors they have
    (a dependency always has fewer than its dependants on acyclic input),
    ties by name. Nodes without ancestors rank first.

    Cyclic input has no such order. ``on_cycle="raise"`` stops with the names
    of some nodes on cycles; ``"group"`` orders the graph of the cycles: its
    ``cycle`` column is the cycle a node is on (null for none), nodes of one
    cycle stand together, and ``n_ancestors`` counts ancestors outside it."""
    if on_cycle not in ("raise", "group"):
        raise ValueError("on_cycle is raise or group")
    counts = closure.groupBy("node").agg(F.count(F.lit(1)).alias("n_ancestors"))
    all_nodes = nodes.select(F.col(node).alias("node")).dropna().dropDuplicates()
    found = all_nodes.join(counts, on="node", how="left").select(
        "node", F.coalesce("n_ancestors", F.lit(0)).alias("n_ancestors"))
    if on_cycle == "raise":
        on = [r["node"] for r in closure.where(F.col("node") == F.col("ancestor")).select("node").limit(5).collect()]
        if on:
            raise ValueError(f"no order: cyclic dependencies, among others of {on}")
        return found.orderBy("n_ancestors", "node")
    rings = cycles(closure).checkpoint(eager=True)
    size = rings.groupBy("cycle").agg(F.count(F.lit(1)).alias("size"))
    found = (found.join(rings, on="node", how="left").join(size, on="cycle", how="left")
             .select("node", (F.col("n_ancestors") - F.coalesce("size", F.lit(0))).alias("n_ancestors"), "cycle"))
    return found.orderBy("n_ancestors", F.coalesce("cycle", "node"), "node")
