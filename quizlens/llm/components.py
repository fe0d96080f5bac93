"""Connected components of a graph of integer ids, by repeated large-star and small-star steps.

Each step is a partial aggregate and a join, so a node with very many neighbours is no single group; the edges of each round are
written to the shared folder, which cuts the lineage. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlens.sinks.stage import stage


def _are_stars(edges: DataFrame) -> bool:
    """Every id hangs on one other id, on which nothing but such ids hang."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        edges.select(F.col("b").alias("id"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    return ends.groupBy("id").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).where("hangs + holds > 1 AND hangs > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every id of edges (a, b) that is not itself the smallest of its component."""
    e = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    while not _are_stars(e):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        joined = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        e = stage(joined.where("a <> b").distinct(), "components")
    return e.select(F.col("a").alias("id"), F.col("b").alias("root"))
