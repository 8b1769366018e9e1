"""Relabelling of a finished dataset by simple rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quaestor.functions import scores as sc
from quaestor.functions import text as tx


def clean_taxonomy(df: DataFrame) -> DataFrame:
    """Downgrade mislabelled questions, drop needless reasoning, rescore the confidence.

    Both downgrades look at the type as it came in. ``fake_calculation`` and
    ``fake_multi_step`` tell which rows they hit.
    """
    kind = F.col("question_type")
    marked = (df
              .withColumn("fake_calculation", (kind == "numeric_calculation")
                          & tx.is_fake_calculation(F.col("reasoning_steps")))
              .withColumn("fake_multi_step", (kind == "multi_step_reasoning")
                          & tx.is_fake_multi_step(F.col("source_passage"))))
    marked = marked.fillna(False, ["fake_calculation", "fake_multi_step"])
    downgraded = (marked
                  .withColumn("question_type", F.when(F.col("fake_calculation") | F.col("fake_multi_step"),
                                                      "fact_extraction").otherwise(kind))
                  .withColumn("difficulty_estimate", F.when(F.col("fake_multi_step"), "medium")
                              .otherwise(F.col("difficulty_estimate"))))
    return (downgraded
            .withColumn("reasoning_steps", F.when(
                F.coalesce(F.col("question_type").isin("fact_extraction", "comparison"), F.lit(False)),
                F.lit(None).cast("string")).otherwise(F.col("reasoning_steps")))
            .withColumn("confidence_score", sc.overlap_confidence(
                F.col("ground_truth_answer"), F.col("source_passage"))))


def cleanup_counters(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(F.count_if("fake_calculation").alias("downgraded_calculations"),
                       F.count_if("fake_multi_step").alias("downgraded_multi_step"))
