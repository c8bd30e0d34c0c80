"""Connected components of a link table by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links(a, b)``; component = smallest node.

    Large-star and small-star rounds until every component is one star
    around its smallest node.  Every step is staged in the shared folder;
    only a yes or no reaches the driver.  A node with very many links is a
    hot join key, which adaptive execution splits, as both join sides are
    staged.
    """
    edges = stage(links.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
                  .filter("lo < hi").distinct(), "cc-links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        smallest = stage(both.groupBy(F.col("lo").alias("node")).agg(F.min("hi").alias("m"))
                         .select("node", F.least("node", "m").alias("m")), "cc-min")
        large = (edges.join(smallest, edges["lo"] == smallest["node"])
                 .select(F.col("m").alias("lo"), "hi").filter("lo < hi"))
        large = stage(large, "cc-large")
        least = stage(large.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("m")), "cc-least")
        small = large.join(least, large["hi"] == least["node"]).select(
            F.explode(F.array(*[F.struct(F.col("m").alias("lo"), F.col(c).alias("hi"))
                                for c in ("lo", "hi")])).alias("e")).select("e.*")
        edges = stage(small.filter("lo < hi").distinct(), "cc-links")
    return (edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
            .unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()))


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end has one link and no smaller end is a larger one too."""
    ends = edges.select(F.explode(F.array(*[
        F.struct(F.col(c).alias("node"), F.lit(n).alias("larger")) for c, n in (("lo", 0), ("hi", 1))
    ])).alias("e")).select("e.*")
    judged = ends.groupBy("node").agg(F.sum("larger").alias("above"), F.min("larger").alias("least"))
    return judged.filter("above > 1 OR (above = 1 AND least = 0)").isEmpty()
