"""Scoring of predicted answers against the ground truth."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quaestor.functions import scores as sc
from quaestor.functions import text as tx

METRICS = ("exact_match", "token_f1", "numeric_match", "composite_score")


def join_predictions(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """Inner join on the exact question text; missing questions meet each other.

    Duplicates multiply. The side to broadcast, if any, is chosen by Spark
    from measured sizes; a hot question is split by the adaptive skew join.
    """
    pred = predictions.select(F.col("question").alias("_question"), "predicted_answer")
    return (truth.join(pred, truth["question"].eqNullSafe(pred["_question"]), "inner")
            .drop("_question"))


def score_pairs(pairs: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Add the four scores to rows with a predicted and a ground-truth answer."""
    staged = (pairs
              .withColumn("_pt", tx.normalized_tokens(F.col("predicted_answer")))
              .withColumn("_gt", tx.normalized_tokens(F.col("ground_truth_answer")))
              .withColumn("_pn", F.array_distinct(tx.extract_numbers(F.col("predicted_answer"))))
              .withColumn("_gn", tx.extract_numbers(F.col("ground_truth_answer"))))
    scored = (staged
              .withColumn("exact_match", sc.exact_match(F.col("_pt"), F.col("_gt")))
              .withColumn("token_f1", sc.token_f1(F.col("_pt"), F.col("_gt")))
              .withColumn("numeric_match", sc.numeric_match(F.col("_pn"), F.col("_gn"), tolerance)))
    return (scored
            .withColumn("composite_score", sc.composite(
                F.col("question_type"), F.col("exact_match"), F.col("token_f1"), F.col("numeric_match")))
            .drop("_pt", "_gt", "_pn", "_gn"))


def collapsed_scores(truth: DataFrame, predictions: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Scores of distinct answer pairs with the number of joined rows each stands for.

    Copies are counted before the join, so a question that fills a third of
    both tables costs one row per distinct answer instead of their product.
    """
    gold = (truth.groupBy("question", "ground_truth_answer", "question_type", "difficulty_estimate")
            .agg(F.count(F.lit(1)).alias("_gold_copies")))
    pred = (predictions.groupBy("question", "predicted_answer")
            .agg(F.count(F.lit(1)).alias("_pred_copies"))
            .withColumnRenamed("question", "_question"))
    joined = (gold.join(pred, gold["question"].eqNullSafe(pred["_question"]), "inner")
              .withColumn("weight", F.col("_gold_copies") * F.col("_pred_copies")))
    scored = score_pairs(joined.drop("_question", "_gold_copies", "_pred_copies"), tolerance)
    return scored.select("question_type", F.col("difficulty_estimate").alias("difficulty"),
                         "weight", *METRICS)


def _weighted_mean(metric: str):
    return F.try_divide(F.sum(F.col(metric) * F.col("weight")), F.sum("weight")).alias(metric)


def overall(scored: DataFrame) -> DataFrame:
    return scored.agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("total_evaluated"),
                      *[_weighted_mean(m) for m in METRICS])


def by_question_type(scored: DataFrame) -> DataFrame:
    return (scored.where(F.col("question_type").isNotNull()).groupBy("question_type")
            .agg(F.sum("weight").alias("count"), *[_weighted_mean(m) for m in METRICS]))


def by_difficulty(scored: DataFrame) -> DataFrame:
    return (scored.where(F.col("difficulty").isNotNull()).groupBy("difficulty")
            .agg(F.sum("weight").alias("count"), _weighted_mean("composite_score")))


def all_levels(scored: DataFrame) -> DataFrame:
    """Overall, per type and per difficulty in one scan of the scores."""
    grouped = scored.groupingSets(
        [[], [F.col("question_type")], [F.col("difficulty")]],
        F.col("question_type"), F.col("difficulty"))
    result = grouped.agg(F.grouping_id().alias("_level"), F.sum("weight").alias("count"),
                         *[_weighted_mean(m) for m in METRICS])
    level = (F.when(F.col("_level") == 3, "overall")
             .when(F.col("_level") == 1, "question_type").otherwise("difficulty"))
    return (result.withColumn("level", level)
            .withColumn("value", F.coalesce("question_type", "difficulty", F.lit("all")))
            .where((F.col("_level") == 3) | F.coalesce("question_type", "difficulty").isNotNull())
            .select("level", "value", "count", *METRICS))


def matched_count(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """How many rows the join yields, without building them."""
    return collapsed_counts(truth, predictions).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("matched"))


def collapsed_counts(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    gold = truth.groupBy("question").agg(F.count(F.lit(1)).alias("_g"))
    pred = (predictions.groupBy("question").agg(F.count(F.lit(1)).alias("_p"))
            .withColumnRenamed("question", "_question"))
    return (gold.join(pred, gold["question"].eqNullSafe(pred["_question"]), "inner")
            .select("question", (F.col("_g") * F.col("_p")).alias("n")))
