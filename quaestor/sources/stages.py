"""Stored stage results, so that a run can go on where another one stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quaestor.sources.filings import path_exists


def load_stage(spark: SparkSession, directory: str, stage: str) -> DataFrame | None:
    """The stored result, or None when the stage has not been finished."""
    path = f"{directory.rstrip('/')}/{stage}"
    return spark.read.parquet(path) if path_exists(spark, f"{path}/_SUCCESS") else None


def save_stage(df: DataFrame, directory: str, stage: str) -> DataFrame:
    """Write the rows and read them back, which also cuts the lineage."""
    path = f"{directory.rstrip('/')}/{stage}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_stage(spark: SparkSession, directory: str, stage: str, build: Callable[[], DataFrame],
              resume: bool = True) -> DataFrame:
    stored = load_stage(spark, directory, stage) if resume else None
    return stored if stored is not None else save_stage(build(), directory, stage)
