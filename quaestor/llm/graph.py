"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quaestor.llm.tables import pin


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``: root is the smallest node that it reaches.

    Alternates two set-wise steps until nothing changes: every node hands its
    larger neighbours to its smallest one, then its smaller neighbours. The
    number of rounds follows the logarithm of the longest path; only two
    numbers of each round reach the driver.
    """
    edges = pin(edges.where(F.col("u") != F.col("v"))
                .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{label}-edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = pin(both.where(F.col("v") > F.col("u")).join(low, "u")
                    .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), f"{label}-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
            .alias("e")).select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct()
        edges = pin(small, f"{label}-small")
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
