"""Connected components of a link table, by alternating stars.

Every round lets each node hand its neighbours to its smallest neighbour: the large star moves the larger
neighbours, the small star the smaller ones.  The link table never grows, no node's neighbours are gathered in one
place (only their minimum is aggregated), and each round is a written table, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfuse.llm.common import written


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """``pairs`` (u, v): each node's minimum over itself and its neighbours replaces the node on one side."""
    least = written(pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
    joined = pairs.join(least, "u")
    if larger:
        moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of comparable, non-null nodes -> (node, component): component is the smallest node that can be
    reached.  Nodes without a link do not appear.  Self links and repeated links are allowed."""
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while not _is_done(edges):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        down = _star(both, larger=True).select(F.col("a").alias("u"), F.col("b").alias("v"))
        edges = written(_star(written(down), larger=False))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _is_done(edges: DataFrame) -> bool:
    """Every node has one smaller neighbour, which has none: all components are stars about their smallest node."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    seen = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 or (up > 0 and down > 0)").isEmpty()
