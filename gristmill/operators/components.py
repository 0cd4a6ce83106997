"""Connected components of an edge table by repeated hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.session import cut_fresh as cut


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component): the smallest node id reachable over undirected edges.

    Each round hooks every node to its smallest neighbour, halves the chains twice and contracts the edges, so the
    number of rounds is logarithmic even for long chains. Edges stay distributed; the driver sees one count a round.
    Edges with a null end are ignored, self loops and repeated edges are harmless, an empty table gives no rows; columns
    other than src and dst are ignored.
    """
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    comp = cut(both.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node")))
    live = cut(both.filter("a <> b").distinct())
    while not live.isEmpty():
        parent = cut(live.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("n"), F.least("a", "low").alias("p")))
        for _ in range(2):
            up = parent.select(F.col("n").alias("p"), F.col("p").alias("pp"))
            parent = cut(parent.join(up, "p", "left").select("n", F.coalesce("pp", "p").alias("p")))
        comp = cut(comp.join(parent.withColumnRenamed("n", "component"), "component", "left").select("node", F.coalesce("p", "component").alias("component")))
        left = live.join(parent.select(F.col("n").alias("a"), F.col("p").alias("pa")), "a")
        live = cut(left.join(parent.select(F.col("n").alias("b"), F.col("p").alias("pb")), "b").filter("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct())
    return comp
