"""Registered queries on answer scoring, with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quaestor.catalog import inputs as src
from quaestor.functions import scores as sc
from quaestor.functions import text as tx
from quaestor.operators import scoring as ev

WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def tokens_sql(expr: str) -> str:
    """Normalised tokens: word runs looked up one by one, so no look-around is needed."""
    runs = rf"regexp_extract_all(lower(coalesce({expr}, 'nan')), '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+')"
    kept = f"array_to_string(list_transform({runs}, lambda w: CASE WHEN w IN ('a', 'an', 'the') THEN ' ' ELSE w END), '')"
    bare = f"""translate({kept}, '!"#$%&''()*+,-./:;<=>?@[\\]^_`{{|}}~', '')"""
    return f"list_filter(regexp_split_to_array({bare}, '{WS}+'), lambda t: t <> '')"


def numbers_sql(expr: str) -> str:
    return (rf"list_transform(regexp_extract_all(coalesce({expr}, 'nan'), '[$]?\d+[,\d]*\.?\d*[%]?'), "
            "lambda m: CAST(translate(m, '$%,', '') AS DOUBLE))")


def words_sql(expr: str) -> str:
    return rf"list_distinct(regexp_extract_all(lower(coalesce({expr}, 'nan')), '[\p{{L}}\p{{N}}_]+'))"


F1_SQL = """CASE WHEN len(pt) = 0 OR len(gt) = 0 THEN CAST(len(pt) = len(gt) AS DOUBLE)
  ELSE 2.0 * coalesce(list_sum(list_transform(list_distinct(pt), lambda w:
    least(len(list_filter(pt, lambda x: x = w)), len(list_filter(gt, lambda y: y = w))))), 0) / (len(pt) + len(gt)) END"""
NUM_MATCH_SQL = """CASE WHEN len(gn) = 0 THEN 1.0 ELSE len(list_filter(gn, lambda g: len(list_filter(pn, lambda p:
    CASE WHEN g = 0 THEN p = 0 ELSE abs(p - g) / abs(g) <= 0.02 END)) > 0)) / len(gn) END"""

SCORED_SQL = f"""v_tok AS (
SELECT *, {tokens_sql('predicted_answer')} AS pt, {tokens_sql('ground_truth_answer')} AS gt,
  {numbers_sql('predicted_answer')} AS pn, {numbers_sql('ground_truth_answer')} AS gn FROM v_pairs),
v_part AS (
SELECT *, CASE WHEN pt = gt THEN 1.0 ELSE 0.0 END AS exact_match, {F1_SQL} AS token_f1, {NUM_MATCH_SQL} AS numeric_match FROM v_tok),
v_scored AS (
SELECT *, CASE WHEN question_type IN ('numeric_calculation', 'multi_step_reasoning') THEN 0.3 * token_f1 + 0.7 * numeric_match
  ELSE 0.7 * token_f1 + 0.3 * exact_match END AS composite_score FROM v_part)"""

# NULL questions meet each other, so the key comparison is IS NOT DISTINCT FROM.
PAIRS_SQL = """v_pairs AS (
SELECT q.*, p.predicted_answer FROM v_qa q JOIN v_pred p ON q.question IS NOT DISTINCT FROM p.question)"""

JOINED = (src.QA_SQL, src.PRED_SQL, PAIRS_SQL)
NUMERIC = (src.NUM_SQL, "v_pairs AS (SELECT * FROM v_num)")
METRIC_AVGS = ", ".join(f"CAST(round(avg({m}), 6) AS DOUBLE) AS {m}" for m in ev.METRICS)


def _rounded(*names: str):
    return [F.round(F.col(n), 6).alias(n) for n in names]


def _scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = ev.join_predictions(src.qa_pairs(spark, sf_dir), src.predictions(spark, sf_dir).drop("ord"))
    return ev.score_pairs(pairs)


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.collapsed_scores(src.qa_pairs(spark, sf_dir), src.predictions(spark, sf_dir))


def normalize_text(spark, sf_dir):
    return src.heavy_table(spark, sf_dir, "documents", "doc_id").select("doc_id", tx.normalize_text(F.col("text")).alias("normalized"))


def extract_numbers(spark, sf_dir):
    orders = src.numeric_pairs(spark, sf_dir).select(
        F.lit("order").alias("origin"), "ord", tx.extract_numbers(F.col("ground_truth_answer")).alias("n"))
    docs = src.heavy_table(spark, sf_dir, "documents", "doc_id").select(
        F.lit("document").alias("origin"), F.col("doc_id").alias("ord"), tx.extract_numbers(F.col("text")).alias("n"))
    return (orders.unionByName(docs)
            .select("origin", "ord", F.posexplode("n").alias("pos", "value")))


def exact_match(spark, sf_dir):
    return _scored_pairs(spark, sf_dir).select("ord", "exact_match")


def token_f1(spark, sf_dir):
    return _scored_pairs(spark, sf_dir).select("ord", *_rounded("token_f1"))


def numeric_match(spark, sf_dir):
    return ev.score_pairs(src.numeric_pairs(spark, sf_dir)).select("ord", *_rounded("numeric_match"))


def composite_score(spark, sf_dir):
    return ev.score_pairs(src.numeric_pairs(spark, sf_dir)).select(
        "ord", "question_type", *_rounded("token_f1", "numeric_match", "composite_score"))


def eval_join(spark, sf_dir):
    return (ev.join_predictions(src.qa_pairs(spark, sf_dir), src.predictions(spark, sf_dir).drop("ord"))
            .select("ord", "question", "ground_truth_answer", "predicted_answer", "question_type",
                    "difficulty_estimate"))


def eval_overall(spark, sf_dir):
    return ev.overall(_levels(spark, sf_dir)).select("total_evaluated", *_rounded(*ev.METRICS))


def eval_by_type(spark, sf_dir):
    return ev.by_question_type(_levels(spark, sf_dir)).select("question_type", "count", *_rounded(*ev.METRICS))


def eval_by_difficulty(spark, sf_dir):
    return ev.by_difficulty(_levels(spark, sf_dir)).select("difficulty", "count", *_rounded("composite_score"))


def eval_grouping_sets(spark, sf_dir):
    return ev.all_levels(_levels(spark, sf_dir)).select("level", "value", "count", *_rounded(*ev.METRICS))


def overlap_confidence(spark, sf_dir):
    return src.qa_pairs(spark, sf_dir).select(
        "ord", sc.overlap_confidence(F.col("ground_truth_answer"), F.col("source_passage")).alias("confidence_score"))


CONFIDENCE_SQL = f"""CASE WHEN ground_truth_answer = '' OR source_passage = '' THEN 0.8
  WHEN len({words_sql('ground_truth_answer')}) = 0 THEN 0.8
  ELSE CAST(format('{{:.2f}}', 0.75 + 0.25 * (CAST(len(list_intersect({words_sql('ground_truth_answer')}, {words_sql('source_passage')})) AS DOUBLE)
    / len({words_sql('ground_truth_answer')}))) AS DOUBLE) END"""

QUERIES = {
    "normalize_text": normalize_text, "extract_numbers": extract_numbers, "exact_match": exact_match,
    "token_f1": token_f1, "numeric_match": numeric_match, "composite_score": composite_score,
    "eval_join": eval_join, "eval_overall": eval_overall, "eval_by_type": eval_by_type,
    "eval_by_difficulty": eval_by_difficulty, "eval_grouping_sets": eval_grouping_sets,
    "overlap_confidence": overlap_confidence,
}

ORACLE = {
    "normalize_text": f"SELECT doc_id, array_to_string({tokens_sql('text')}, ' ') AS normalized FROM documents",
    "extract_numbers": src.with_ctes(src.NUM_SQL, body=f"""
SELECT origin, ord, CAST(pos - 1 AS INTEGER) AS pos, n[pos] AS value FROM (
  SELECT origin, ord, n, unnest(range(1, len(n) + 1)) AS pos FROM (
    SELECT 'order' AS origin, ord, {numbers_sql('ground_truth_answer')} AS n FROM v_num
    UNION ALL SELECT 'document', doc_id, {numbers_sql('text')} FROM documents))"""),
    "exact_match": src.with_ctes(*JOINED, SCORED_SQL, body="SELECT ord, CAST(exact_match AS DOUBLE) AS exact_match FROM v_scored"),
    "token_f1": src.with_ctes(*JOINED, SCORED_SQL, body="SELECT ord, CAST(round(token_f1, 6) AS DOUBLE) AS token_f1 FROM v_scored"),
    "numeric_match": src.with_ctes(*NUMERIC, SCORED_SQL, body="SELECT ord, CAST(round(numeric_match, 6) AS DOUBLE) AS numeric_match FROM v_scored"),
    "composite_score": src.with_ctes(*NUMERIC, SCORED_SQL, body="""SELECT ord, question_type, CAST(round(token_f1, 6) AS DOUBLE) AS token_f1,
  CAST(round(numeric_match, 6) AS DOUBLE) AS numeric_match, CAST(round(composite_score, 6) AS DOUBLE) AS composite_score FROM v_scored"""),
    "eval_join": src.with_ctes(*JOINED, body="SELECT ord, question, ground_truth_answer, predicted_answer, question_type, difficulty_estimate FROM v_pairs"),
    "eval_overall": src.with_ctes(*JOINED, SCORED_SQL, body=f"SELECT count(*) AS total_evaluated, {METRIC_AVGS} FROM v_scored"),
    "eval_by_type": src.with_ctes(*JOINED, SCORED_SQL, body=f"SELECT question_type, count(*) AS count, {METRIC_AVGS} FROM v_scored GROUP BY 1"),
    "eval_by_difficulty": src.with_ctes(*JOINED, SCORED_SQL, body="""SELECT difficulty_estimate AS difficulty, count(*) AS count,
  CAST(round(avg(composite_score), 6) AS DOUBLE) AS composite_score FROM v_scored GROUP BY 1"""),
    "eval_grouping_sets": src.with_ctes(*JOINED, SCORED_SQL, body=f"""
SELECT 'overall' AS level, 'all' AS value, count(*) AS count, {METRIC_AVGS} FROM v_scored
UNION ALL SELECT 'question_type', question_type, count(*), {METRIC_AVGS} FROM v_scored GROUP BY 2
UNION ALL SELECT 'difficulty', difficulty_estimate, count(*), {METRIC_AVGS} FROM v_scored GROUP BY 2"""),
    "overlap_confidence": src.with_ctes(src.QA_SQL, body=f"SELECT ord, {CONFIDENCE_SQL} AS confidence_score FROM v_qa"),
}
