"""Connected components of a large graph by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieproof.llm.tables import saved


def components(edges: DataFrame, hashed: bool = False) -> DataFrame:
    """``node, component`` of every node of ``edges`` (``a``, ``b`` long) that has another as a neighbour.

    ``component`` is the smallest node that it is linked with. In each round every
    node goes over to the first among its neighbours and itself, in a random
    order, and the edges are drawn anew between where their ends went; edges that
    became loops go, so a share of the nodes vanishes in every round, and stars
    are done after two. ``hashed`` says that the nodes are hashes, which serve as
    their own order. Minima are aggregates that combine before the shuffle, and
    joins are split where a node is skewed.
    """
    order = F.col if hashed else F.xxhash64
    real = edges.where("a <> b")
    graph = saved(real.select("a", "b").union(real.select("b", "a")).toDF("u", "v").distinct(), light=True)
    steps = []
    while not graph.isEmpty():
        first = graph.groupBy("u").agg(F.min_by("v", order("v")).alias("m"))
        moved = saved(first.select("u", F.when(order("m") < order("u"), F.col("m")).otherwise(F.col("u")).alias("m")), light=True)
        steps.append(moved)
        ends = graph.join(moved, "u").select("v", F.col("m").alias("u"))
        ends = ends.join(moved.select(F.col("u").alias("v"), F.col("m").alias("w")), "v")
        graph = saved(ends.where("u <> w").select("u", F.col("w").alias("v")).distinct(), light=True)
    if not steps:
        return graph.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out = steps[0].select(F.col("u").alias("node"), F.col("m").alias("component"))
    for moved in steps[1:]:
        later = moved.select(F.col("u").alias("component"), "m")
        out = out.join(later, "component", "left").select("node", F.coalesce("m", "component").alias("component"))
    if hashed:
        return out
    least = out.groupBy("component").agg(F.min("node").alias("least"))
    return out.join(least, "component").select("node", F.col("least").alias("component"))
