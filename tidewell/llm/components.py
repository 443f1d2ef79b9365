"""Connected components of an edge table, by alternating large and small stars.

Every round is two aggregations and two joins over the edges, written to the shared folder; a node with
very many edges is aggregated before the shuffle, and its edges are kept out of the shuffle of the join. The
number of rounds is logarithmic in the longest chain for all practical graphs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.joins import join_unique
from tidewell.session import settle


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each node below the smallest of the node and its neighbours."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    hung = join_unique(near.filter("b > a"), least, ["a"])
    return hung.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours below the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = join_unique(down, least, ["a"]).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that has an edge to another node; the root is the smallest node.

    Loops, repeated edges and edges with a null end have no effect.
    """
    now = settle(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark or not seen[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root"))
            ).distinct()
        mark = tuple(seen)
        now = settle(_small_star(_large_star(now)).filter("a <> b").distinct(), "edges")
