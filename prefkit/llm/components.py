"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefkit.llm.common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One contraction of ``links`` (a > b). Large: a node's larger neighbours are linked to its least
    one. Small: a node and its smaller neighbours are linked to the least of them."""
    if large:
        near = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = links
    least = near.groupBy("a").agg(F.min("b").alias("m"))
    least = least.withColumn("m", F.least("a", "m"))
    joined = near.join(least, "a")
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return out.filter("a > b").distinct()


def _unsettled(links: DataFrame) -> DataFrame:
    """Nodes that keep ``links`` (a > b) from being stars around the least node of each component:
    those with two least ones, and those that are least for one node and not for themselves."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(1).alias("up")), F.struct(F.col("b").alias("id"), F.lit(0).alias("up"))))
    nodes = links.select(ends.alias("e")).groupBy("e.id").agg(F.sum("e.up").alias("up"), F.min("e.up").alias("low"))
    return nodes.filter("up > 1 OR (up = 1 AND low = 0)")


def components(links: DataFrame) -> DataFrame:
    """Node -> component of the nodes of ``links`` (a, b: long ids): id, component (the least id).

    Alternates large-star and small-star contractions until the links are stars around the least
    node of each component (a number of rounds that grows with the logarithm of the nodes). Each
    round's links are written to the shared folder. No node's links meet in one task unaggregated:
    minima are taken per task first, and the join splits a node that has many links. Self links
    and repeated links are allowed; nodes without any other node do not appear.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(ordered.filter("a > b").distinct(), "cc-links")
    while not _unsettled(now).isEmpty():
        now = written(_star(_star(now, True), False), "cc-round")
    least = now.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(least)
