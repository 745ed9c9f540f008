"""Connected components of a graph given by its links, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import release, settle


def is_forest(edges: DataFrame) -> bool:
    """Whether the links (u, v), v below u, are stars already: every u has one v,
    which is no other link's u. Counted per node with partial sums."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``links``; the root is its component's
    smallest node. Alternates large and small stars until only stars are left;
    each half of a round is written to the shared folder, so no lineage grows, no
    half is planned or computed twice, and a lost executor repeats one at most. A
    centre with very many links is only ever aggregated with partial minima and
    joined, never gathered."""
    edges = settle(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links")
    while not is_forest(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = settle(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large-stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = settle(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "stars")
        release(links.sparkSession)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
