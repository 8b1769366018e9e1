"""Connected components of similar pairs, scope by scope."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quaestor.session import pin


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``scope, node, part`` of all nodes of ``edges(scope, i, j)``; ``part`` is the least node that a node reaches.

    Every round hands the larger neighbours of each node to its least one and
    then the smaller ones to their least, and is stored once. Paths halve with
    every round, so a chain of n nodes takes about log n of them. A node with
    very many neighbours is one row per neighbour, never a list.
    """
    links = edges.where("i != j").select("scope", F.greatest("i", "j").alias("u"), F.least("i", "j").alias("v")).distinct()
    state, before = pin(links, label), None
    while True:
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("scope", "u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
        both = state.unionByName(state.select("scope", F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("scope", "u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        handed = both.where("v > u").join(least, ["scope", "u"]).select("scope", F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = handed.groupBy("scope", "u").agg(F.min("v").alias("m"))
        met = handed.join(lowest, ["scope", "u"])
        pairs = met.select("scope", "u", F.col("m").alias("v")).unionByName(met.select("scope", F.col("v").alias("u"), F.col("m").alias("v")))
        state = pin(pairs.where("u != v").distinct(), label)
    roots = state.select("scope", F.col("v").alias("node"), F.col("v").alias("part")).distinct()
    return state.select("scope", F.col("u").alias("node"), F.col("v").alias("part")).unionByName(roots)
