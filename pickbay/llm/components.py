"""Connected components of a link table, for graphs far smaller than the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickbay.llm.common import stage


def _larger_to_smallest(edges: DataFrame, name: str) -> DataFrame:
    """Tie every larger neighbour of a node to the node's smallest neighbour (or itself).
    The minima are written, so that the join can split a node of very many links."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), name)
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def _smaller_to_smallest(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them (a > b in `edges`)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, label): the smallest node each linked node can reach.

    `links` has long columns a and b; nodes without links don't appear.  The two
    star steps alternate until the edges are stars around the smallest nodes;
    each round is a staged table, minima are taken by partial aggregates and no
    neighbour list is ever gathered.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .where("a <> b").distinct(), name)
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
                edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        state = now
        edges = stage(_smaller_to_smallest(_larger_to_smallest(edges, f"{name}-least")), name)
