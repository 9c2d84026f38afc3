"""Connected components of links, by Spark joins over contracted graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import Scratch, staged


def _stars(edges: DataFrame) -> bool:
    """Whether every u > v of the edges has one v, which is no u itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("centre")).union(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("centre")))
    ends = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("centre").alias("centre"))
    return not ends.where("below + centre > 1 AND below > 0").agg(F.count(F.lit(1))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); label is the component's smallest node.

    Large-star and small-star steps in turn: every node's neighbours are linked to its
    smallest one. Each step keeps the components, and the links end as stars around the
    smallest nodes, after about log n rounds; links that are such stars need none. Smallest neighbours are combined before the
    shuffle; the join that follows splits a node with very many links.
    """
    with Scratch(links.sparkSession) as scratch:
        edges = scratch(
            links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
        while not _stars(edges):
            both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            # Written first: the join then reads two plain shuffles, of which hot parts can be split.
            least = scratch(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m")), "least")
            large = scratch(
                both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .where("u <> v").distinct(), "links")
            # Here u > v always: a node's smaller neighbours and itself go to the smallest.
            least = scratch(large.groupBy("u").agg(F.min("v").alias("m")), "least")
            edges = scratch(
                large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
                .where("u <> v").distinct(), "links")
        roots = edges.select(F.col("v").alias("node")).distinct()
        return staged(edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
            roots.select("node", F.col("node").alias("label"))), "labels")
