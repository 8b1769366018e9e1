"""Reading, pinning and keying of tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from quaestor.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pin(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again.

    What is read more than once, or would be computed again when an executor
    is lost, is kept this way.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """``base`` or a longer name that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def with_row_id(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The rows of ``df`` with an id of their own, and the name of its column.

    Later reads agree on it even for rows that are equal or have no id. Rows
    straight from files that number them are known by file and place, and
    nothing is written; all others are pinned with a number each.
    """
    name = free_name(df, "row_id")
    if df._jdf.queryExecution().analyzed().children().isEmpty():
        try:
            place = df.metadataColumn("_metadata")
            return df.select("*", F.struct(F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("row")).alias(name)), name
        except AnalysisException:
            pass  # not from such files
    return pin(df.withColumn(name, F.monotonically_increasing_id()), label), name


def held_back(doc_id, parts: int):
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts))
