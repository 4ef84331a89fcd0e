"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stayline.session import durable


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for all nodes with an edge.

    ``edges`` has integers ``u`` and ``v``. Large-star and small-star steps alternate until the
    edges are stars; each step links nodes to the least neighbour they know of. Every step is a
    grouped minimum, combined before its shuffle, and a join that AQE splits at heavy nodes. Each
    result is written to the shared folder, so lineage stays short. An isolated node isn't listed.
    """
    least, most = F.least("u", "v"), F.greatest("u", "v")
    edges = durable(edges.where("u <> v").select(most.alias("u"), least.alias("v")).distinct())
    before = None
    while True:
        stars = durable(_small_star(_large_star(edges)))
        state = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(state) == before:
            break
        before, edges = tuple(state), stars
    roots = stars.select("v").distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select("v", "v")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges from larger ``u`` to smaller ``v``; every ``v`` of a ``u`` is linked to the least."""
    edges = edges.distinct()
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), "m")
    return moved.union(least.select("u", "m")).distinct().withColumnRenamed("m", "v")
