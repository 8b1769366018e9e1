"""Mergeable summaries of text lengths: stored once per filing, merged for every question asked later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

K = 400  # size parameter of a sketch; ranks are off by less than one per cent or so
RANK_ERROR = 0.02  # what callers may rely on


def length_summaries(texts: DataFrame, text: str, by: Sequence[str], k: int = K) -> DataFrame:
    """One row per group of ``by``: number of texts, least and greatest length, and a quantile sketch of a few kilobytes.

    Null texts don't count; a group without texts has no sketch. Sketches are
    built per task and merged, so a group of any size costs one row per task.
    """
    length = F.length(text).cast("bigint")
    return texts.groupBy(*by).agg(F.count(length).alias("n"), F.min(length).alias("least"), F.max(length).alias("most"),
                                  F.kll_sketch_agg_bigint(length, F.lit(k)).alias("sketch"))


def merged(summaries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Stored summaries as summaries of larger groups, or of everything."""
    return summaries.where("n > 0").groupBy(*by).agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), F.kll_merge_agg_bigint("sketch").alias("sketch"))


def quantiles(summaries: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``share`` and ``length`` per summary; the ends are exact."""
    def at(share: Column) -> Column:
        inner = F.kll_sketch_get_quantile_bigint("sketch", share)
        return F.when(share <= 0, F.col("least")).when(share >= 1, F.col("most")).otherwise(inner)
    rows = F.array(*[F.struct(F.lit(float(s)).alias("share"), at(F.lit(float(s))).alias("length")) for s in shares])
    kept = [c for c in summaries.columns if c not in ("sketch", "least", "most")]
    return summaries.where("n > 0").select(*kept, F.inline(rows))
