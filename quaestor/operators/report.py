"""Aggregates of a finished dataset and the report made from them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Row, Window, functions as F

from quaestor.functions import text as tx
from quaestor.operators.sections import SECTION_NAMES
from quaestor.options import Options
from quaestor.schemas import DIFFICULTIES, QUESTION_TYPES, REASONING_TYPES


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value with their share of all rows; rows without a value count in the total only."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    share = F.col("count") * 100.0 / total
    return (counts.where(F.col(column).isNotNull())
            .select(column, "count", share.alias("pct"))
            .withColumn("label", tx.percent_label(F.col("pct")))
            .withColumn("bar", tx.percent_bar(F.col("pct"))))


def fixed_distribution(df: DataFrame, column: str, domain: tuple[str, ...] = DIFFICULTIES) -> DataFrame:
    """Rows per value of a closed domain in its own order, with zero rows; one pass, no join."""
    counted = df.agg(F.count(F.lit(1)).alias("_total"),
                     *[F.count_if(F.col(column) == value).alias(f"_{value}") for value in domain])
    rows = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(value).alias(column), F.col(f"_{value}").alias("count"))
                     for i, value in enumerate(domain)])
    share = F.try_divide(F.col("count") * F.lit(100.0), F.col("_total"))
    return (counted.select("_total", F.inline(rows))
            .select("pos", column, "count", share.alias("pct"))
            .withColumn("label", tx.percent_label(F.col("pct")))
            .withColumn("bar", tx.percent_bar(F.col("pct"))))


def length_stats(df: DataFrame) -> DataFrame:
    passage = F.length("source_passage")
    return df.agg(F.avg(passage).alias("passage_avg"), F.min(passage).alias("passage_min"),
                  F.max(passage).alias("passage_max"), F.avg(F.length("ground_truth_answer")).alias("answer_avg"),
                  F.avg(F.length("question")).alias("question_avg"))


def reasoning_coverage(df: DataFrame) -> DataFrame:
    """Rows with reasoning against rows whose type asks for it."""
    return (df.agg(F.count("reasoning_steps").alias("has_reasoning"),
                   F.count_if(F.col("question_type").isin(*REASONING_TYPES)).alias("needs_reasoning"))
            .withColumn("pct", F.try_divide(F.col("has_reasoning") * F.lit(100.0), F.col("needs_reasoning"))))


def samples(df: DataFrame, order_by: str = "ord", per_type: int = Options().samples_per_type) -> DataFrame:
    """The first rows of every question type.

    Spark keeps only ``per_type`` rows per type and task ahead of the shuffle.
    """
    place = F.array_position(F.array(*[F.lit(t) for t in QUESTION_TYPES]), F.col("question_type"))
    first = Window.partitionBy("question_type").orderBy(order_by)
    return (df.where(F.col("question_type").isin(*QUESTION_TYPES))
            .withColumn("sample", F.row_number().over(first)).where(F.col("sample") <= per_type)
            .withColumn("type_pos", place.cast("int"))
            .withColumn("title", tx.title_label(F.col("question_type"))))


def run_counts(raw: int, verified: int) -> dict[str, float]:
    rate = verified / raw * 100 if raw else 0.0
    return {"rejected": raw - verified, "acceptance_rate": rate, "rejection_rate": 100 - rate}


def _table(head: list[str], rows: list[list]) -> str:
    lines = ["| " + " | ".join(head) + " |", "|" + "|".join([":---"] * len(head)) + "|"]
    return "\n".join(lines + ["| " + " | ".join(str(c) for c in row) + " |" for row in rows])


def totals(df: DataFrame, sections: tuple[str, ...] = SECTION_NAMES) -> DataFrame:
    """One row with every number of the report, from one pass over the dataset.

    Counts go by the closed domains of type, difficulty and section; what lies
    outside of them is what is left of ``rows``.
    """
    domains = {"type": ("question_type", QUESTION_TYPES), "level": ("difficulty_estimate", DIFFICULTIES), "place": ("section", sections)}
    counts = [F.count_if(F.col(column) == value).alias(f"{name}_{k}")
              for name, (column, values) in domains.items() for k, value in enumerate(values)]
    passage = F.length("source_passage")
    return df.agg(F.count(F.lit(1)).alias("rows"), *counts, F.avg(passage).alias("passage_avg"), F.min(passage).alias("passage_min"),
                  F.max(passage).alias("passage_max"), F.avg(F.length("ground_truth_answer")).alias("answer_avg"),
                  F.avg(F.length("question")).alias("question_avg"), F.count("reasoning_steps").alias("has_reasoning"),
                  F.count_if(F.col("question_type").isin(*REASONING_TYPES)).alias("needs_reasoning"))


def shares(row: Row, name: str, values: tuple[str, ...]) -> list[tuple[str, int, str, str]]:
    """Value, rows, percentage and bar of each value that occurs, the most frequent first, then the rest."""
    found = [(value, row[f"{name}_{k}"]) for k, value in enumerate(values)]
    found.append(("(other or none)", row["rows"] - sum(n for _, n in found)))
    out = []
    for value, n in sorted((f for f in found if f[1]), key=lambda f: -f[1]):
        share = 100.0 * n / row["rows"]
        out.append((value, n, f"{share:.1f}%", "█" * int(share // 5)))
    return out


def render_report(df: DataFrame, raw: int, verified: int, removed: int, seconds: float, calls: int,
                  cik: str, order_by: str = "ord") -> str:
    """Markdown report. One row of numbers and two samples per type reach the driver."""
    row = totals(df).first()
    picked = samples(df, order_by).orderBy("type_pos", "sample").collect()
    counts = run_counts(raw, verified)

    parts = [
        f"# Dataset report, company {cik}",
        f"Written {datetime.now():%Y-%m-%d %H:%M}.",
        "## The run in numbers",
        _table(["Step", "Pairs"], [
            ["Generated", raw], ["Accepted by verification", f"{verified} ({counts['acceptance_rate']:.1f}%)"],
            ["Turned down", f"{counts['rejected']} ({counts['rejection_rate']:.1f}%)"],
            ["Dropped as near-duplicates", removed], ["In the dataset", row["rows"]]]),
        f"The run took {seconds:.0f} seconds and {calls} requests. A pair is accepted if its passage backs the answer and "
        "is enough to answer the question; the two are judged apart.",
    ]
    for title, name, values in (("Kinds of question", "type", QUESTION_TYPES), ("Levels", "level", DIFFICULTIES),
                                ("Filing sections", "place", SECTION_NAMES)):
        parts += [f"## {title}", _table(["Value", "Pairs", "Share"], [[v, n, f"{label} {bar}".strip()] for v, n, label, bar in shares(row, name, values)])]
    parts.append("## Examples")
    for pair in picked:
        if pair["sample"] == 1:
            parts.append(f"### {pair['title']}")
        lines = [f"- Question: {pair['question']}", f"- Answer: {pair['ground_truth_answer']}"]
        if pair["reasoning_steps"]:
            lines.append(f"- Steps: {pair['reasoning_steps']}")
        parts.append("\n".join([*lines, f"- From {pair['section']}, {pair['difficulty_estimate']}"]))
    parts.append("## Lengths and steps")
    lines = []
    if row["passage_avg"] is not None:
        lines = [f"- Passages: {row['passage_avg']:.0f} characters on average, {row['passage_min']} to {row['passage_max']}",
                 f"- Answers: {row['answer_avg']:.0f} characters on average",
                 f"- Questions: {row['question_avg']:.0f} characters on average"]
    if row["needs_reasoning"]:
        lines.append(f"- {row['has_reasoning']} pairs have steps, {row['needs_reasoning']} are of a kind that needs them "
                     f"({100.0 * row['has_reasoning'] / row['needs_reasoning']:.0f}%)")
    return "\n\n".join([*parts, "\n".join(lines)])
