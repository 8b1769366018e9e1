"""Answer scores as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quaestor.functions import text as tx
from quaestor.functions.binding import bind
from quaestor.schemas import REASONING_TYPES

# The only two-decimal ties in [0.75, 1.00] that round downwards
# when the exact binary value decides, as it does in Python's round().
BINARY_TIES_DOWN = (0.815, 0.825, 0.835, 0.845, 0.855, 0.865, 0.955, 0.965, 0.975, 0.985, 0.995)


def exact_match(pred_tokens: Column, gold_tokens: Column) -> Column:
    return F.when(pred_tokens == gold_tokens, 1.0).otherwise(0.0)


def shared_token_count(pred_tokens: Column, gold_tokens: Column) -> Column:
    """Size of the multiset intersection, in one pass over the sorted tokens.

    Predicted tokens (side 0) come before gold tokens (side 1) of the same
    word, so each gold token matches while fewer gold than predicted ones
    have been seen.
    """
    tagged = F.sort_array(F.concat(
        F.transform(pred_tokens, lambda t: F.struct(t.alias("t"), F.lit(0).alias("side"))),
        F.transform(gold_tokens, lambda t: F.struct(t.alias("t"), F.lit(1).alias("side")))))

    def step(acc: Column, item: Column) -> Column:
        same = acc["t"] == item["t"]
        left = F.when(same, acc["left"]).otherwise(0)
        is_pred = item["side"] == 0
        matched = ~is_pred & (left > 0)
        return F.struct(
            item["t"].alias("t"),
            F.when(is_pred, left + 1).when(matched, left - 1).otherwise(left).alias("left"),
            F.when(matched, acc["common"] + 1).otherwise(acc["common"]).alias("common"))

    zero = F.struct(F.lit("").alias("t"), F.lit(0).alias("left"), F.lit(0).alias("common"))
    return F.aggregate(tagged, zero, step, lambda acc: acc["common"])


def token_f1(pred_tokens: Column, gold_tokens: Column) -> Column:
    # Harmonic mean of c/p and c/g, written as 2c/(p+g) so that the fold appears once.
    n_pred, n_gold = F.size(pred_tokens), F.size(gold_tokens)
    return (F.when((n_pred == 0) | (n_gold == 0), (n_pred == n_gold).cast("double"))
            .otherwise(F.lit(2.0) * shared_token_count(pred_tokens, gold_tokens)
                       / F.greatest(n_pred + n_gold, F.lit(1))))


def numeric_match(pred_numbers: Column, gold_numbers: Column, tolerance: float = 0.02) -> Column:
    """Share of gold numbers that some predicted number meets within the tolerance."""
    def close(gold: Column) -> Column:
        return F.exists(pred_numbers, lambda p: F.when(gold == 0, p == 0).otherwise(
            F.try_divide(F.abs(p - gold), F.abs(gold)) <= tolerance))

    n_gold = F.size(gold_numbers)
    return (F.when(n_gold == 0, 1.0)
            .otherwise(F.size(F.filter(gold_numbers, close)) / F.greatest(n_gold, F.lit(1))))


def composite(question_type: Column, em: Column, f1: Column, num: Column) -> Column:
    return (F.when(question_type.isin(*REASONING_TYPES), F.lit(0.3) * f1 + F.lit(0.7) * num)
            .otherwise(F.lit(0.7) * f1 + F.lit(0.3) * em))


def round_half_binary(score: Column) -> Column:
    """Two decimals, ties decided by the exact binary value."""
    rounded = F.round(score, 2)
    return F.when(F.round(score, 9).isin(*BINARY_TIES_DOWN), F.round(score - 0.005, 2)).otherwise(rounded)


def overlap_confidence(answer: Column, passage: Column) -> Column:
    """0.75 to 1.00 by the share of answer words found in the passage."""
    ratio = bind(tx.word_set(answer), lambda words: F.try_divide(
        F.size(F.array_intersect(words, tx.word_set(passage))), F.size(words)))
    blank = (answer == "") | (passage == "")
    score = bind(F.lit(0.75) + F.lit(0.25) * ratio, round_half_binary)
    return F.when(F.coalesce(blank, F.lit(False)), 0.8).otherwise(F.coalesce(score, F.lit(0.8)))
