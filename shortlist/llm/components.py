"""Connected components of an edge table of any size, by contraction to stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortlist.session import durable, release


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, component): the smallest node that each node reaches.

    Alternates two joins until nothing changes: every neighbour above a node is tied to the node's
    smallest neighbour, then every neighbour below it is. The number of rounds grows with the
    logarithm of the longest path. Minima are combined before the shuffle, and the join back can
    split a node with very many neighbours. Nodes of ``edges`` alone appear; an empty table gives
    an empty table.
    """
    edges = durable(_above(edges))
    while True:
        up = durable(_above(_tie_above(edges)))
        down = durable(_above(_tie_below(up)))
        before, after = _state(edges), _state(down)
        release(edges, up)
        edges = down
        if before == after:
            break
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _above(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _tie_above(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _tie_below(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionAll(least.select("a", F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    # a checksum over all edges; decimals cannot overflow
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(row)
