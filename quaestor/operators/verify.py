"""Batched verification of question-answer pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from quaestor.functions import text as tx
from quaestor.operators.ordinals import batch_of, with_ordinal
from quaestor.options import Options


def assign_batches(pairs: DataFrame, order_by: Sequence[str] = ("ord",), scope: Sequence[str] = (),
                   size: int = 5) -> DataFrame:
    """Cut the ordered pairs of every scope into batches; ``qa_index`` counts inside the batch."""
    numbered = with_ordinal(pairs, order_by, scope, "_ordinal")
    batch, place = batch_of(F.col("_ordinal"), size)
    return numbered.withColumn("batch_id", batch).withColumn("qa_index", place).drop("_ordinal")


def batch_texts(batched: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """The labelled lines of every batch as one text; a group has at most one batch of rows."""
    # Fixed value: the line format of a pair.
    block = F.format_string(
        "--- QA Pair %d ---\nSection: %s\nQuestion: %s\nAnswer: %s\nSource Passage: %s\nQuestion Type: %s\n",
        "qa_index", "section", "question", "ground_truth_answer", "source_passage", "question_type")
    ordered = F.sort_array(F.collect_list(F.struct("qa_index", block.alias("block"))))
    return (batched.groupBy(*scope, "batch_id")
            .agg(ordered.alias("_blocks"), F.count(F.lit(1)).alias("batch_size"))
            .select(*scope, "batch_id", "batch_size",
                    F.array_join(F.transform("_blocks", lambda b: b["block"]), "\n").alias("qa_pairs_text")))


def _wrapped(batched: DataFrame, verdicts: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Verdicts with indices below zero counted from the end of their batch."""
    keys = [*scope, "batch_id"]
    sizes = batched.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    index = F.when((F.col("qa_index") < 0) & F.col("_size").isNotNull(), F.col("qa_index") + F.col("_size")).otherwise(F.col("qa_index"))
    return verdicts.join(sizes, keys, "left").withColumn("qa_index", index.cast("int")).drop("_size")


def join_verdicts(batched: DataFrame, verdicts: DataFrame, scope: Sequence[str] = (),
                  wrap_negative: bool = False) -> DataFrame:
    """Attach verdicts by batch and index.

    Indices beyond the batch find no pair, repeated ones yield repeated rows,
    pairs without a verdict drop out. With ``wrap_negative`` an index below
    zero counts from the end of its batch.
    """
    if wrap_negative:
        verdicts = _wrapped(batched, verdicts, scope)
    return batched.join(verdicts, [*scope, "batch_id", "qa_index"], "inner")


def verdict_audit(batched: DataFrame, verdicts: DataFrame, scope: Sequence[str] = (), wrap_negative: bool = False,
                  order_by: Sequence[str] = ()) -> DataFrame:
    """Every verdict and every pair once, with what has become of it as ``outcome``.

    ``matched`` is the first verdict on a pair (in the order of ``order_by``),
    ``repeated`` a further one, ``out of range`` a verdict without a pair, and
    ``without verdict`` a pair without one. Verdicts of one batch are few, so
    a window over batch and index stays small.
    """
    keys = [*scope, "batch_id", "qa_index"]
    if wrap_negative:
        verdicts = _wrapped(batched, verdicts, scope)
    same = Window.partitionBy(*keys).orderBy(*order_by) if order_by else Window.partitionBy(*keys).orderBy(F.lit(1))
    told = verdicts.withColumn("_turn", F.row_number().over(same))
    pairs = batched.withColumn("_pair", F.lit(True))
    outcome = (F.when(F.col("_turn").isNull(), "without verdict").when(F.col("_pair").isNull(), "out of range")
               .when(F.col("_turn") > 1, "repeated").otherwise("matched"))
    return pairs.join(told, keys, "full_outer").withColumn("outcome", outcome).drop("_turn", "_pair")


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("is_faithful") & F.col("is_answerable"))


def with_reasons(judged: DataFrame) -> DataFrame:
    reasons = F.array_compact(F.array(F.when(~F.col("is_faithful"), "unfaithful"),
                                      F.when(~F.col("is_answerable"), "unanswerable")))
    return judged.withColumn("reasons", F.array_join(reasons, ", "))


def rejected(judged: DataFrame, length: int = Options().question_preview) -> DataFrame:
    """Rejected pairs with their reasons and a short form of the question."""
    return (with_reasons(judged).where(F.col("reasons") != "")
            .withColumn("question_preview", tx.preview(F.col("question"), length)))


def rejects(judged: DataFrame, audit: DataFrame, length: int = Options().question_preview) -> DataFrame:
    """The reject table of a run: rejected pairs, and what the audit could not match, with its outcome as the reason."""
    unmatched = (audit.where(F.col("outcome") != "matched").withColumnRenamed("outcome", "reasons")
                 .withColumn("question_preview", tx.preview(F.col("question"), length)))
    return rejected(judged, length).unionByName(unmatched, allowMissingColumns=True)


def rejection_reasons(judged: DataFrame) -> DataFrame:
    return rejected(judged).groupBy("reasons").agg(F.count(F.lit(1)).alias("count"))


def acceptance_rate(pairs: DataFrame, judged: DataFrame) -> DataFrame:
    """Accepted and rejected verdicts against all pairs that went in."""
    total = pairs.agg(F.count(F.lit(1))).scalar()
    ok = F.col("is_faithful") & F.col("is_answerable")
    counts = judged.agg(F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("rejected"))
    return (counts.withColumn("total", total)
            .withColumn("acceptance_rate", F.coalesce(
                F.try_divide(F.col("accepted") * F.lit(100.0), F.col("total")), F.lit(0.0))))


def verified_dataset(judged: DataFrame) -> DataFrame:
    """Accepted pairs in the layout of the finished dataset."""
    return judged.select(
        *[c for c in ("doc_id", "ord") if c in judged.columns], "question", F.col("answer").alias("ground_truth_answer"),
        "source_passage", "question_type", F.col("difficulty").alias("difficulty_estimate"), "section",
        F.coalesce("confidence", F.lit(1.0)).alias("confidence_score"), "reasoning_steps")
