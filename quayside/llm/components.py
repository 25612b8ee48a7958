"""Connected components of a graph of links, as Spark jobs over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (a, b): root is the smallest node of its component.

    Alternates two steps until every component is a star: every node hands its larger neighbours to its smallest
    one (large star), and then its smaller ones (small star). A star's centre is found by an aggregate that combines
    map-side and joined back, so a node with any number of neighbours is never gathered in one task.
    """
    links = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    while not _stars(links):
        both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links = materialize(_star(both).filter("n > a").select(F.col("n").alias("a"), F.col("m").alias("b")).distinct())
        # every link now goes from the larger to the smaller node
        links = materialize(_star(links).select(F.col("n").alias("a"), F.col("m").alias("b")).filter("a <> b").unionAll(_lowest(links)).distinct())
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return materialize(roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct()))


def _stars(links: DataFrame) -> bool:
    """Whether every node has one link up at most, and none if any lead down to it."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    counted = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counted.agg(F.count_if(F.expr("up > 1 or (up > 0 and down > 0)"))).first()[0] == 0


def _star(links: DataFrame) -> DataFrame:
    """Rows n, m, a for each link a - n, where m is the smallest of a and its neighbours."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
    return links.join(least, F.col("a") == F.col("c")).select(F.col("b").alias("n"), "m", "a")


def _lowest(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("b"))
