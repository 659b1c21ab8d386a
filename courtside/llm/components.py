"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from courtside.session import store


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) of every node that has an edge.

    ``edges`` has ``a`` and ``b`` of one orderable type; loops, nulls and repeats add nothing.
    Alternates large and small star steps, which hang the neighbours of each node on the smallest
    of them, until the edges are stars. Each round is written, so a lost executor costs one round at
    most; minima are taken before the shuffle and the joins with them can be split, so a node with
    very many neighbours is spread over tasks.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs, seen = store(pairs), None
    while True:
        mark = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(mark) == seen or not mark[0]:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = tuple(mark)
        pairs = store(_small_star(_large_star(pairs)))


def _large_star(pairs: DataFrame) -> DataFrame:
    """Each larger neighbour of a node goes to the smallest node around it."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of these."""
    low = pairs.groupBy("a").agg(F.min("b").alias("low"))
    others = pairs.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return others.unionByName(low.select("a", F.col("low").alias("b"))).distinct()
