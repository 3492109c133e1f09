"""Property graphs as two DataFrames: components, lineage, neighbourhoods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnflow.session import cut


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 50) -> DataFrame:
    """(node, component): weakly connected components, named by their least node.

    Alternates large-star and small-star steps, so the number of rounds grows with the logarithm
    of the longest path. Every round is written to the shared folder; a node of any degree is
    reduced by partial minima. NULL ends and loops are no edges; isolated nodes don't appear.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    nodes = None
    links = cut(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    nodes = links
    for _ in range(most_rounds):
        # Large star: every node's greater neighbours point to the least in its neighbourhood.
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        # Small star: every node's lesser neighbours and the node itself point to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        small = cut(small)
        same = small.join(links, ["u", "v"], "left_anti").isEmpty() and links.join(small, ["u", "v"], "left_anti").isEmpty()
        links = small
        if same:
            break
    else:
        raise RuntimeError(f"components didn't settle in {most_rounds} rounds")
    label = links.groupBy("u").agg(F.min("v").alias("m"))
    every = nodes.select(F.col("u").alias("node")).unionByName(nodes.select(F.col("v").alias("node"))).distinct()
    return every.join(label, every["node"] == label["u"], "left").select("node", F.coalesce("m", "node").alias("component"))


def canonical_ids(merges: DataFrame, old: str, new: str, most_hops: int = 10) -> DataFrame:
    """(old, canonical): every merged id with the end of its chain, followed at most ``most_hops`` steps.

    A cycle has no end: its members stay themselves. Pointer doubling needs few rounds.
    """
    links = merges.where(F.col(old).isNotNull() & F.col(new).isNotNull() & (F.col(old) != F.col(new))).groupBy(F.col(old).alias("o")).agg(F.min(new).alias("n"))
    jumps, hops = cut(links), 1
    while hops < most_hops:
        ahead = jumps.select(F.col("o").alias("n"), F.col("n").alias("further"))
        moved = cut(jumps.join(ahead, "n", "left").select("o", F.coalesce("further", "n").alias("n")))
        hops *= 2
        if moved.join(jumps, ["o", "n"], "left_anti").isEmpty():
            jumps = moved
            break
        jumps = moved
    ends = jumps.join(links.select(F.col("o").alias("__more")), F.col("n") == F.col("__more"), "left")
    return ends.select(F.col("o").alias(old), F.when(F.col("__more").isNull(), F.col("n")).otherwise(F.col("o")).alias("canonical"))


def neighbourhood(edges: DataFrame, start: DataFrame, source: str, target: str, hops: int, node: str = "node") -> DataFrame:
    """(start, node, hops): nodes within ``hops`` undirected steps of every start, each at its least distance.

    All starts go together; a round joins the new frontier with the edges and drops what was seen.
    """
    both = edges.select(F.col(source).alias("u"), F.col(target).alias("v")).unionByName(edges.select(F.col(target).alias("u"), F.col(source).alias("v"))).where("u IS NOT NULL AND v IS NOT NULL").distinct()
    seen = cut(start.select(F.col(node).alias("start"), F.col(node), F.lit(0).alias("hops")).distinct())
    frontier = seen
    for i in range(1, hops + 1):
        reached = frontier.join(both, frontier[node] == both["u"]).select("start", F.col("v").alias(node)).distinct()
        frontier = cut(reached.join(seen, ["start", node], "left_anti").withColumn("hops", F.lit(i)))
        seen = seen.unionByName(frontier)
    return seen


def shared_neighbours(edges: DataFrame, source: str, target: str, a, b) -> DataFrame:
    """Sources that lead to both targets ``a`` and ``b``."""
    return edges.where(F.col(target) == a).select(source).intersect(edges.where(F.col(target) == b).select(source))
