"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockrecon.llm.common import durable


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node that can be reached, for every node of an edge.

    ``edges`` has two columns of one type, ends in any order; repeated edges, loops and nulls
    are harmless. Large-star and small-star steps alternate, as minima by node and joins back,
    so no neighbourhood is ever held in one place; a node with very many neighbours has one row
    on the other side of its joins, which Spark may split. Each round is written to the shared
    folder. Without edges the result is empty.
    """
    a, b = edges.columns
    current = durable(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    before = _fingerprint(current)
    while before[0]:
        current = durable(_small_star(_large_star(current)), "edges")
        now = _fingerprint(current)
        if now == before:
            break
        before = now
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    ends = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
        edges.select(F.col("v").alias("x"), F.col("u").alias("y"))
    )
    least = ends.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    return ends.where(F.col("y") > F.col("x")).join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
