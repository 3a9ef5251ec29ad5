"""Connected components of a graph in tables: alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import discard, staged, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, are linked to the least of them. Here v < u."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, *, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); component is the least node reachable.

    Each round writes its edges to the shared folder, so lineage stays short and a lost executor
    costs one round. Minima combine before the shuffle and the joins back are split where a node is
    hot, so a hub doesn't gather in one task. Loops and nulls are dropped; an empty table gives an
    empty result.
    """
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    spark = edges.sparkSession
    now, path = stored(now, "components-0")
    mark = None
    for k in range(1, most_rounds + 1):
        large = _large_star(now).distinct()
        now, new = stored(_small_star(large).distinct(), f"components-{k}")
        discard(spark, path)
        path = new
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components didn't settle in {most_rounds} rounds")
    now = staged(now, "components")
    discard(spark, path)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
