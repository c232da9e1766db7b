"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialized


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """For edges (a, b) of longs: (node, root), the smallest node of each node's component, for all nodes with an edge.

    Alternating stars: every node hangs its larger neighbours on the smallest node it knows, then its smaller ones.
    Each round is a partial aggregation and a join on the node, both on the edges alone, and ends in a reliable
    checkpoint; the edges shrink towards one star for each component in a logarithmic number of rounds.
    """
    now = materialized(_stars(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()))
    seen = _state(now)
    for _ in range(most_rounds):
        now = materialized(_stars(now))
        new = _state(now)
        if new == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select(F.col("b"), F.col("b")).distinct())
        seen = new
    raise RuntimeError("components did not settle")


def _stars(edges: DataFrame) -> DataFrame:
    """One large and one small star step on edges a > b."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h")).first()
    return row["n"], row["h"]
