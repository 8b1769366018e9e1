"""A training corpus from ``documents``: five stages, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaestor.llm.decontaminate import drop_contaminated
from quaestor.llm.line_dedup import drop_repeated_lines
from quaestor.llm.mixing import mixed
from quaestor.llm.simhash import drop_near_duplicates
from quaestor.llm.tables import pin, read_table
from quaestor.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the clause grammar, fitted to ``labels``, scores as toxic."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the lines that an earlier document has; drops documents that consist of such lines."""
    return drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group with SimHash fingerprints within two bits."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which five per cent or more of the words lie in benchmark windows."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix of sources takes, with the number of copies."""
    return mixed(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("mixing", mixing)]
ORACLE_SQL = None  # the toxicity model and patience diff can't be expressed


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
