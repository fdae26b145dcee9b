"""Connected components of a graph given by its edges, by rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.tables import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) of every node of ``edges`` (``a``, ``b``, both long).

    Each round hangs every node's larger neighbours on its smallest one, then its smaller ones; rounds end when nothing
    changes, after about as many as the logarithm of the longest path. Only edges are moved, by node; each round's edges
    are checkpointed, so that the plan doesn't grow and lost executors cost no more than a round."""
    edges = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written out, so that Spark can split the join where a node has very many neighbours.
        least = checkpointed(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = checkpointed(hung.unionByName(small.select("a", F.col("m").alias("b"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
