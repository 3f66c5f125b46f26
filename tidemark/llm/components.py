"""Connected components of a graph given as edges, by contraction.

A round gives every node the least node, by a hash drawn anew each round, among itself and
its neighbours, follows these choices four steps, and turns the edges into distinct edges
between the nodes that were reached. A node is kept only if it is the least around it or
at the end of a long descent, so a round leaves at most about half of the nodes that have
edges, and about a third of a chain: rounds grow with the logarithm of the graph, on
shrinking tables, whatever its shape. Then the choices are read back from the last round to
the first, and each component is named by its least node.

Rounds are written tables in the shared folder, so lineage stays short; one small count per
round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage


def _choices(edges: DataFrame, seed: int) -> DataFrame:
    """(node, up) for each node that has edges; ``edges`` hold one direction of each."""
    def order(c):
        return F.struct(F.xxhash64(F.lit(seed), F.col(c)).alias("h"), F.col(c).alias("n"))
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.groupBy("a").agg(F.min(order("b")).alias("near"))
    out = stage(near.select(F.col("a").alias("node"), F.least(order("a"), F.col("near"))["n"].alias("up")), "choices")
    for _ in range(2):
        then = out.select(F.col("node").alias("via"), F.col("up").alias("further"))
        out = out.join(then, out.up == then.via).select("node", F.col("further").alias("up"))
    return stage(out, "choices")


def components(edges: DataFrame) -> DataFrame:
    """edges: (a, b) longs. Returns (node, component): the least node reachable, itself included.

    Only nodes with an edge to another node have a row.
    """
    def once(x, y):
        return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")
    e = stage(edges.where("a <> b").select(*once("a", "b")).distinct(), "edges")
    chosen: list[DataFrame] = []
    while e.limit(1).count() or not chosen:
        c = _choices(e, len(chosen))
        chosen.append(c)
        a = c.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        b = c.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        e = stage(e.join(a, "a").join(b, "b").where("ua <> ub").select(*once("ua", "ub")).distinct(), "edges")
    labels = chosen.pop()
    while chosen:
        lower = chosen.pop()
        upper = labels.select(F.col("node").alias("up"), F.col("up").alias("top"))
        labels = stage(lower.join(upper, "up", "left").select("node", F.coalesce("top", "up").alias("up")), "labels")
    least = labels.groupBy("up").agg(F.min("node").alias("component"))
    return labels.join(least, "up").select("node", "component")
