"""Connected components of an edge table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.staging import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for every node with a link; the component is its smallest node.

    ``edges`` has two long columns, in any order and with repeats.  Each round is a
    written table, so rounds do not lengthen the plan and survive lost executors.
    """
    a, b = edges.columns
    links = stage(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(), "links"
    )
    while True:
        links = stage(_small_star(_large_star(links)), "links")
        if links.join(links.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the smallest node around it."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """The smaller neighbours of each node, and itself, move to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    rest = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least).distinct()
