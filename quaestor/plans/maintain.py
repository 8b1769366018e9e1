"""Cleanup and scoring of stored datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quaestor.operators import cleanup as cl
from quaestor.operators import scoring as ev
from quaestor.operators import report as rp
from quaestor.options import Options
from quaestor.schemas import DIFFICULTIES, QUESTION_TYPES
from quaestor.plans.build import DATASET, write_text
from quaestor.sources import datasets as ds
from quaestor.sources import stages as st


def cleanup_dataset(spark: SparkSession, source: str, target: str, stage_dir: str, raw: int = 0, verified: int = 0,
                    removed: int = 0, seconds: float = 0.0, requests: int = 0, options: Options = Options()) -> dict:
    """Relabel a stored dataset into a new folder. Without counts of the original run the rows read stand in for them."""
    outputs = f"{target}/qa_pairs.csv", f"{target}/qa_pairs.jsonl"
    ds.check_target(spark, *outputs)
    rows = ds.read_qa_pairs(spark, source).withColumn("ord", F.monotonically_increasing_id())
    cleaned = st.save_stage(cl.clean_taxonomy(rows), stage_dir, "cleaned")
    ds.write_csv(cleaned.select(*DATASET), outputs[0])
    ds.write_jsonl(cleaned.select(*DATASET), outputs[1])
    size = cleaned.count()
    write_text(spark, rp.render_report(cleaned, raw or size, verified or size, removed, seconds, requests, options.cik),
               f"{target}/quality_report.md")
    return {"rows": size, **cl.cleanup_counters(cleaned).first().asDict()}


def score_files(spark: SparkSession, dataset: str, predictions: str, infer: bool = False) -> DataFrame:
    """All levels of scores for a dataset and a predictions file; ``infer`` reads predicted answers by the type of their column."""
    return ev.all_levels(ev.collapsed_scores(ds.read_qa_pairs(spark, dataset), ds.read_predictions(spark, predictions, infer)))


def match_counts(spark: SparkSession, dataset: str, predictions: str) -> tuple[int, int]:
    """Rows of the dataset joined with predictions, and rows of the dataset."""
    truth = ds.read_qa_pairs(spark, dataset)
    return ev.matched_count(truth, ds.read_predictions(spark, predictions)).first()["matched"], truth.count()


def format_scores(levels: DataFrame) -> str:
    """At most one row per known question type and difficulty reaches the driver; other values are left out."""
    known = (F.col("level") == "overall") | F.col("value").isin(*QUESTION_TYPES, *DIFFICULTIES)
    rows = levels.where(known).orderBy("level", "value").collect()
    lines = ["EVALUATION RESULTS"]
    for row in (r for r in rows if r["level"] == "overall"):
        if not row["count"]:
            return "No matching questions: the question texts have to be exactly the same on both sides."
        lines += [f"Overall ({row['count']} questions): exact match {row['exact_match']:.3f}, token F1 {row['token_f1']:.3f}, "
                  f"numeric match {row['numeric_match']:.3f}, composite {row['composite_score']:.3f}"]
    for row in (r for r in rows if r["level"] == "question_type"):
        lines.append(f"{row['value']} (n={row['count']}): F1 {row['token_f1']:.3f}, numeric {row['numeric_match']:.3f}, "
                     f"composite {row['composite_score']:.3f}")
    for row in (r for r in rows if r["level"] == "difficulty"):
        lines.append(f"{row['value']} (n={row['count']}): composite {row['composite_score']:.3f}")
    return "\n".join(lines)
