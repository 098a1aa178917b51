"""Connected components of a graph given as rows of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.storage import stored

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(a long, b long) -> node, root for every linked node; root is the smallest node of its component.

    Large-star and small-star steps by turns until every component is a star: every step hangs the neighbours of a
    node onto the smallest one, so the rows never get more than the links, and a hub's neighbours are
    rows of their own, aggregated before they are shuffled. The number of rounds grows with the
    logarithm of the longest path; links that are stars need none. Each round is written to the shared folder.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    )
    for _ in range(MOST_ROUNDS):
        if _stars(edges):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct()
            )
        # large star: every neighbour larger than the node moves to the smallest of node and neighbours
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = stored(large)
        # small star: a node and its smaller neighbours move to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            .where("a != b")
            .distinct()
        )
        edges = stored(small)
    raise RuntimeError("the components did not settle")


def _stars(edges: DataFrame) -> bool:
    """Whether all components are settled: each larger node of an edge has that edge only."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.max((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1)))).first()[0]
