"""Connected components of an edge table, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, scope


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a long, b long); component is the smallest node reachable.

    Edges stay distributed; the driver learns one thing a round, whether there is more to do. Ends when every edge leads to a root.
    """
    with scope():
        edges = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        while True:
            both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
            large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            large = large.filter("a <> b")
            low = large.groupBy("a").agg(F.min("b").alias("m"))
            small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
            edges = materialize(small.filter("a <> b").distinct(), "edges")
            # every edge leads to a root once no node has two edges out, or one out and one in
            ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("in")).union(edges.select("b", F.lit(0), F.lit(1)))
            if ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("in").alias("in")).filter("out + in > 1").isEmpty():
                break
        roots = edges.select(F.col("b").alias("node")).distinct()
        found = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node").alias("component")))
        return materialize(found, "components", result=True)


def forest_roots(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge to a smaller one: ``edges`` (a, b) have b < a and one b for each a.

    Every node's pointer is replaced by its parent's, so a path is halved each round. A parent with many children is
    the wide side of a join with rows that are unique, which Spark splits.
    """
    with scope():
        edges = materialize(edges.select("a", "b").distinct(), "pointers")
        while True:
            above = edges.select(F.col("a").alias("b"), F.col("b").alias("above"))
            edges = materialize(edges.join(above, "b", "left").select("a", F.coalesce("above", "b").alias("b"), F.col("above").isNotNull().alias("moved")), "pointers")
            if edges.filter("moved").isEmpty():
                return materialize(edges.select(F.col("a").alias("node"), F.col("b").alias("component")), "roots", result=True)
            edges = edges.select("a", "b")
