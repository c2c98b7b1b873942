"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.scratch import written


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours link to its smallest neighbour, or to itself."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours link to the smallest of them."""
    mins = _smallest(links)
    rest = links.join(mins, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(mins.select("u", F.col("m").alias("v"))).distinct()


def _done(links: DataFrame) -> bool:
    """True if every node links to one node, and that one to none."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("top"))
    ends = ends.unionByName(links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("top")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("top").alias("top")).where("up + top > 1").isEmpty()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its smallest node.

    Two joins and sums a round, some log(nodes) rounds; each round's links are written to the
    shared folder. Loops and repeated edges do no harm, a null end does not link, and without
    edges the result is empty.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = written(_small_star(_large_star(links)), label)
    while not _done(links):
        links = written(_small_star(_large_star(links)), label)
    named = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return named.unionByName(named.select(F.col("component").alias("node"), "component").distinct())
