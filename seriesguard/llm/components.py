"""Connected components of a graph that grows with the data, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

#: A safety stop far above the number of rounds that any graph needs, which is about log2 of its nodes.
MAX_ROUNDS = 100


def _least(edges: DataFrame) -> DataFrame:
    """Each node ``u`` with the smallest of its neighbours ``v`` and itself."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node hang on its smallest."""
    both = edges.select(F.explode(F.array(F.struct(F.col("u"), F.col("v")), F.struct(
        F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")
    return both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, hang on the smallest. Edges lead from larger to smaller nodes."""
    least = _least(edges)
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): the root is the smallest node that links reach."""
    edges = store(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v"), "edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        edges = store(_small(_large(edges).distinct()).distinct(), "edges")
        new = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if new == mark or not new[0]:
            break
        mark = new
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
