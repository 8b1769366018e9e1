"""Chunks of newly arrived filings, each filing once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quaestor.options import Options
from quaestor.plans.build import filing_chunks
from quaestor.sources.filings import file_id

_FILES = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                       T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def filing_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    files = (spark.readStream.format("binaryFile").schema(_FILES)
             .option("maxFilesPerTrigger", files_per_batch).load(folder))
    return files.select(file_id(F.col("path")).alias("doc_id"), F.col("path").alias("file"), F.col("content").alias("html"))


def ingest(spark: SparkSession, folder: str, target: str, progress: str, options: Options = Options()) -> None:
    """Chunk all filings that arrived since the last call and stop.

    The stream's own checkpoint in ``progress`` remembers which files are
    done, so a lost run goes on where it stopped. Nothing here needs state.
    """
    chunks = filing_chunks(filing_stream(spark, folder), options)
    query = (chunks.writeStream.format("parquet").option("path", target).option("checkpointLocation", progress)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
