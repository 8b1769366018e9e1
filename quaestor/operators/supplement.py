"""Filling sections that have no question-answer pairs yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quaestor.options import Options

# Sections to fill, most important first.
PRIORITY = ("Item 7: MD&A", "Item 8: Financial Statements", "Item 1A: Risk Factors", "Item 7A: Market Risk Disclosures")
STATEMENTS = PRIORITY[1]


def missing_sections(chunks: DataFrame, existing: DataFrame) -> DataFrame:
    """Chunks of sections without a pair in the same filing."""
    covered = existing.select("doc_id", "section").distinct()
    return chunks.join(covered, ["doc_id", "section"], "left_anti")


def chunks_per_section(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("section").agg(F.count(F.lit(1)).alias("n_chunks"))


def prioritize(chunks: DataFrame, options: Options = Options()) -> DataFrame:
    """Chunks of the listed sections with their priority; of the statements the first ``options.statement_chunks``.

    ``chunk_index`` counts from zero without gaps inside a section, so the
    first chunks are those with a low index and nothing has to be ranked.
    """
    place = F.array_position(F.array(*map(F.lit, PRIORITY)), F.col("section")).cast("int")
    within = (F.col("section") != STATEMENTS) | (F.col("chunk_index") < options.statement_chunks)
    return chunks.withColumn("priority", place).where((F.col("priority") > 0) & within)


def merge_pairs(existing: DataFrame, added: DataFrame) -> DataFrame:
    """All pairs; ``src_rank`` keeps the existing ones ahead of the added ones."""
    return (existing.withColumn("src_rank", F.lit(0))
            .unionByName(added.withColumn("src_rank", F.lit(1))))
