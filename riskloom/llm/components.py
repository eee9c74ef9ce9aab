"""Connected components of a distributed graph (union-find by stars).

Alternates large-star and small-star steps (each hangs a node's neighbours on
their smallest member) until nothing changes. A step is one aggregation that
combines before the shuffle and one equi-join, which AQE may split at a hot
node; its edges are stored in the shared folder, so a lost executor costs one
step at most. Only the edge count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import discard, stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return near.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` of every node of an edge; the component is its least node.

    Any orderable type. Edges with a null end are dropped, loops and repeated
    edges are harmless (a node with only loops is its own component); no
    edges give no rows.
    """
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    ends = stored(ends.distinct(), "edges")
    now, state = ends.filter(F.col("a") != F.col("b")), None
    before = None
    while True:
        now = stored(_small_star(_large_star(now)), "stars")
        if before is not None:
            discard(before)
        before = now
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    own = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    loops = ends.filter(F.col("a") == F.col("b")).select(F.col("a").alias("node"), F.col("a").alias("component"))
    alone = loops.join(roots, "node", "left_anti")
    return roots.union(own).union(alone).distinct()
