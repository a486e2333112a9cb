"""Connected components of a large graph by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` (``a``, ``b``), the root being its component's smallest.

    Large-star hooks larger neighbours to a node's smallest one, small-star the smaller ones; both keep
    connectivity and end in stars. The smallest neighbour is aggregated before the shuffle and joined
    back, so a node with a third of the edges is split like any skewed join. Every round is written out.
    Self-links and repeated links do no harm; NULL nodes must be removed before.
    """
    edges = written(edges.where("a <> b").select("a", "b").distinct(), label)
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()
        large = written(large.where("a <> b"), label)
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("root"))
        hooked = down.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        small = hooked.unionByName(least.select("a", F.col("root").alias("b"))).where("a <> b").distinct()
        edges = written(small, label)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.groupBy("a").agg(F.min("b").alias("root"))
    ends = roots.select(F.col("a").alias("node"), "root")
    return ends.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
