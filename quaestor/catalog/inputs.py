"""Question-answer tables, predictions, verdicts and filings drawn from the given tables.

Each input exists twice: as a DataFrame and as the SQL of a common table
expression for the oracle. Whole tables and whole texts are used throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quaestor.schemas import QUESTION_TYPES
from quaestor.session import spread

# The section names that a filing is cut into.
SECTION_NAMES = ("Item 1: Business", "Item 1A: Risk Factors", "Item 7: MD&A",
                 "Item 7A: Market Risk Disclosures", "Item 8: Financial Statements")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def heavy_table(spark: SparkSession, sf_dir: str, name: str, key: str, rows: int | None = None) -> DataFrame:
    """A table whose rows are costly to work on; see :func:`quaestor.session.spread`."""
    return spread(table(spark, sf_dir, name), key, rows=rows)


def _pick(index, values):
    chosen = F.lit(values[-1])
    for i, value in reversed(list(enumerate(values[:-1]))):
        chosen = F.when(index == i, F.lit(value)).otherwise(chosen)
    return chosen


def qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn and the assistant turn behind it make one question-answer pair."""
    talks = table(spark, sf_dir, "conversations")
    asked = talks.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    told = (talks.where("role = 'assistant'")
            .select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("ground_truth_answer")))
    c, t = F.col("conv_id"), F.col("turn")
    passage = (F.when((c + t) % 3 == 0, F.col("ground_truth_answer")).when((c + t) % 3 == 1, F.col("question"))
               .otherwise(F.concat_ws(" ", "question", "ground_truth_answer")))
    reasoning = (F.when(c % 3 == 0, F.lit(None).cast("string")).when(c % 3 == 1, "Step 1: 4 + 5 = 9")
                 .otherwise("first consider the whole"))
    return (asked.join(told, ["conv_id", "turn"])
            .select("conv_id", (c * 100 + t).alias("ord"), "question", "ground_truth_answer",
                    passage.alias("source_passage"),
                    _pick((c + t) % 4, QUESTION_TYPES).alias("question_type"),
                    _pick((c * 7 + t) % 3, ("easy", "medium", "hard")).alias("difficulty_estimate"),
                    _pick(c % 5, SECTION_NAMES).alias("section"),
                    F.lit(1.0).alias("confidence_score"), reasoning.alias("reasoning_steps")))


QA_SQL = """v_qa AS (
SELECT u.conv_id, u.conv_id * 100 + u.turn AS ord, u.text AS question, a.text AS ground_truth_answer,
  CASE (u.conv_id + u.turn) % 3 WHEN 0 THEN a.text WHEN 1 THEN u.text
    ELSE u.text || ' ' || a.text END AS source_passage,
  CASE (u.conv_id + u.turn) % 4 WHEN 0 THEN 'fact_extraction' WHEN 1 THEN 'numeric_calculation'
    WHEN 2 THEN 'comparison' ELSE 'multi_step_reasoning' END AS question_type,
  CASE (u.conv_id * 7 + u.turn) % 3 WHEN 0 THEN 'easy' WHEN 1 THEN 'medium' ELSE 'hard' END AS difficulty_estimate,
  CASE u.conv_id % 5 WHEN 0 THEN 'Item 1: Business' WHEN 1 THEN 'Item 1A: Risk Factors' WHEN 2 THEN 'Item 7: MD&A'
    WHEN 3 THEN 'Item 7A: Market Risk Disclosures' ELSE 'Item 8: Financial Statements' END AS section,
  CAST(1.0 AS DOUBLE) AS confidence_score,
  CASE u.conv_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Step 1: 4 + 5 = 9' ELSE 'first consider the whole' END AS reasoning_steps
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant')"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact, padded, unrelated and missing answers, and one class under a changed question."""
    qa = qa_pairs(spark, sf_dir)
    case = F.col("ord") % 5
    answer = (F.when(case == 0, F.col("ground_truth_answer"))
              .when(case == 1, F.concat_ws(" ", "question", "ground_truth_answer"))
              .when(case == 2, F.col("question"))
              .when(case == 3, F.lit(None).cast("string"))
              .otherwise(F.concat(F.lit("The "), F.lower("ground_truth_answer"), F.lit("!"))))
    asked = F.when((case == 4) & (F.col("conv_id") % 2 == 0), F.concat("question", F.lit("?"))).otherwise(F.col("question"))
    return qa.select("ord", asked.alias("question"), answer.alias("predicted_answer"))


PRED_SQL = """v_pred AS (
SELECT ord, CASE WHEN ord % 5 = 4 AND conv_id % 2 = 0 THEN question || '?' ELSE question END AS question,
  CASE ord % 5 WHEN 0 THEN ground_truth_answer WHEN 1 THEN question || ' ' || ground_truth_answer
    WHEN 2 THEN question WHEN 3 THEN NULL ELSE 'The ' || lower(ground_truth_answer) || '!' END AS predicted_answer
FROM v_qa)"""


def numeric_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers full of numbers, one for every order."""
    orders = heavy_table(spark, sf_dir, "orders", "o_orderkey")
    price = F.col("o_totalprice").cast("decimal(15,2)")
    key = F.col("o_orderkey")
    gold = F.concat(F.lit("The order total was $"), price.cast("string"), F.lit(" and "),
                    (key % 50).cast("string"), F.lit("% of 2,024.5 units"))
    near = (price * F.lit("1.01").cast("decimal(3,2)")).cast("string")
    far = (price * F.lit("1.05").cast("decimal(3,2)")).cast("string")
    pred = (F.when(key % 3 == 0, F.concat(F.lit("about "), near, F.lit(", 2024")))
            .when(key % 3 == 1, F.concat(F.lit("about "), far)).otherwise("no numbers"))
    return orders.select(key.alias("ord"), gold.alias("ground_truth_answer"), pred.alias("predicted_answer"),
                         F.when(key % 2 == 0, "numeric_calculation").otherwise("comparison").alias("question_type"))


NUM_SQL = """v_num AS (
SELECT o_orderkey AS ord,
  'The order total was $' || CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) || ' and ' || CAST(o_orderkey % 50 AS VARCHAR) || '% of 2,024.5 units' AS ground_truth_answer,
  CASE o_orderkey % 3 WHEN 0 THEN 'about ' || CAST(CAST(o_totalprice AS DECIMAL(15,2)) * CAST(1.01 AS DECIMAL(3,2)) AS VARCHAR) || ', 2024'
    WHEN 1 THEN 'about ' || CAST(CAST(o_totalprice AS DECIMAL(15,2)) * CAST(1.05 AS DECIMAL(3,2)) AS VARCHAR) ELSE 'no numbers' END AS predicted_answer,
  CASE o_orderkey % 2 WHEN 0 THEN 'numeric_calculation' ELSE 'comparison' END AS question_type
FROM orders)"""


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One verdict per pair; some unfaithful, some unanswerable, some both."""
    key = F.col("ord")
    return qa_pairs(spark, sf_dir).select(
        "ord", (key % 7 != 0).alias("is_faithful"), (key % 11 != 0).alias("is_answerable"),
        ((key % 10).cast("double") / 10).alias("confidence"))


VERDICT_SQL = """v_verdict AS (
SELECT ord, ord % 7 <> 0 AS is_faithful, ord % 11 <> 0 AS is_answerable, CAST(ord % 10 AS DOUBLE) / 10 AS confidence FROM v_qa)"""


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four documents in a row become the body of one filing, behind a table of contents.

    Grouping by ``doc_id div 4`` uses every document once, at most four per group.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    part = [F.coalesce(F.max(F.when(F.col("doc_id") % 4 == i, F.col("text"))), F.lit("")).alias(f"t{i}")
            for i in range(4)]
    bodies = docs.groupBy(F.floor(F.col("doc_id") / 4).alias("doc_id")).agg(*part)
    text = F.concat(
        F.lit("Table of Contents\nItem 1. Business\nItem 1A. Risk Factors\nItem 7. Management\n"
              "Item 8. Financial Statements\n\nItem 1. Business\n"), F.col("t0"),
        F.lit("\n 12 \nITEM 1A: RISK  FACTORS\n"), F.col("t1"), F.lit("\n13\nItem 7. Management\n"), F.col("t2"),
        F.lit("\n\n\nItem 8. Financial Statements\n"), F.col("t3"))
    return bodies.select("doc_id", text.alias("full_text"))


FILING_SQL = """v_bodies AS (
SELECT CAST(floor(doc_id / 4) AS BIGINT) AS doc_id,
  coalesce(max(text) FILTER (doc_id % 4 = 0), '') AS t0, coalesce(max(text) FILTER (doc_id % 4 = 1), '') AS t1,
  coalesce(max(text) FILTER (doc_id % 4 = 2), '') AS t2, coalesce(max(text) FILTER (doc_id % 4 = 3), '') AS t3
FROM documents GROUP BY 1),
v_filing AS (
SELECT doc_id, concat('Table of Contents', chr(10), 'Item 1. Business', chr(10), 'Item 1A. Risk Factors', chr(10),
  'Item 7. Management', chr(10), 'Item 8. Financial Statements', chr(10), chr(10),
  'Item 1. Business', chr(10), t0, chr(10), ' 12 ', chr(10), 'ITEM 1A: RISK  FACTORS', chr(10), t1, chr(10), '13', chr(10),
  'Item 7. Management', chr(10), t2, chr(10), chr(10), chr(10), 'Item 8. Financial Statements', chr(10), t3) AS full_text
FROM v_bodies)"""


def with_ctes(*ctes: str, body: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n" + body
