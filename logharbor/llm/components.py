"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logharbor.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the smallest node around it instead."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    rest = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(least.withColumnRenamed("m", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node, component` for every node with an edge; the component is its smallest node.

    `edges` has the columns a and b, in any direction, repeated or not; loops and nulls are ignored. Each
    round is written to the shared folder; rounds grow with the logarithm of the largest component.
    The smallest node comes from a partial aggregate, and the join that hands it out may be split, so a
    node with very many edges does not end in one task.
    """
    edges = written(edges.select("a", "b").where("a <> b").distinct(), "components")
    state = None
    while (now := _state(edges)) != state:
        state = now
        if not now[0]:
            break
        edges = written(small_star(large_star(edges)), "components")
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return pairs.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
