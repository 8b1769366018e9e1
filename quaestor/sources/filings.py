"""Reading filing indexes and filing texts."""

from __future__ import annotations

import time
import urllib.request
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quaestor.functions import edgar
from quaestor.operators.html import html_to_text
from quaestor.options import Options
from quaestor.schemas import EDGAR_SUBMISSIONS
from quaestor.session import pin


def read_submissions(spark: SparkSession, path: str) -> DataFrame:
    """Filing indexes, one JSON document per file; the company number comes from the file name."""
    cik = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)", 1)
    return (spark.read.schema(EDGAR_SUBMISSIONS).option("multiLine", True).json(path)
            .select(cik.alias("cik"), "name", "filings"))


def parse_submissions(df: DataFrame, json_col: str = "submissions") -> DataFrame:
    """Filing indexes held as JSON text in a column."""
    parsed = F.from_json(F.col(json_col), EDGAR_SUBMISSIONS)
    return df.withColumn("_index", parsed).select(*df.columns, "_index.name", "_index.filings")


def latest_filing(indexes: DataFrame) -> DataFrame:
    """First 10-K of every index with its address and local name; NULL columns where there is none.

    Everything happens inside the row: the parallel arrays are zipped and the
    first match is taken.
    """
    cik = F.col("cik")
    found = indexes.withColumn("_hit", edgar.first_annual_report(F.col("filings.recent")))
    url = edgar.filing_url(cik, F.col("_hit.accession"), F.col("_hit.document"))
    return (found.select(*[c for c in indexes.columns if c != "filings"],
                         F.col("_hit.accession").alias("accession"), url.alias("url"))
            .withColumn("file_name", edgar.cache_filename(cik, F.col("accession"), F.col("url"))))


def read_filings(spark: SparkSession, path: str) -> DataFrame:
    """Whole HTML files as they are, one row per file; the parser decodes them and replaces bad bytes.

    ``doc_id`` is a hash of the file's name (company and accession number), so
    it stays the same when a folder moves or is read under another scheme.
    """
    raw = spark.read.format("binaryFile").load(path)
    return raw.select(file_id(F.col("path")).alias("doc_id"), F.col("path").alias("file"),
                      F.regexp_extract("path", r"10k_([^_/]*)_", 1).alias("cik"), F.col("content").alias("html"))


def file_id(path: Column) -> Column:
    return F.xxhash64(F.element_at(F.split(path, "/"), -1))


def filing_texts(filings: DataFrame) -> DataFrame:
    """Flat text of every filing; ``text_error`` tells why one has none."""
    return html_to_text(filings, "html", "full_text", "text_error").drop("html")


def _downloads(data_dir: str) -> str:
    return f"{data_dir.rstrip('/')}/downloaded"


def stored_filings(spark: SparkSession, data_dir: str, ciks: DataFrame) -> DataFrame:
    """``doc_id, file, cik, html`` of the stored filings of the given companies: files of their own, else downloads.

    A company's number is looked up as it was given; of several filings the
    first by name counts.
    """
    found = []
    if any_path(spark, f"{data_dir.rstrip('/')}/10k_*_*.htm*"):
        found.append(read_filings(spark, f"{data_dir.rstrip('/')}/10k_*_*.htm*").withColumn("_rank", F.lit(0)))
    if path_exists(spark, f"{_downloads(data_dir)}/_SUCCESS"):
        loaded = spark.read.parquet(_downloads(data_dir)).where(F.col("html").isNotNull())
        found.append(loaded.select(file_id(F.col("file")).alias("doc_id"), "file", "cik", F.col("html").cast("binary").alias("html"),
                                   F.lit(1).alias("_rank")))
    if not found:
        return spark.createDataFrame([], "doc_id long, file string, cik string, html binary")
    rows = reduce(DataFrame.unionByName, found).join(ciks.select("cik").distinct(), "cik", "left_semi")
    first = rows.groupBy("cik").agg(F.min(F.struct("_rank", "file")).alias("_first"))
    return (rows.join(first.select("cik", "_first.*"), ["cik", "_rank", "file"], "left_semi")
            .select("doc_id", "file", "cik", "html"))


def download(spark: SparkSession, data_dir: str, ciks: DataFrame, options: Options = Options(), fetch=None,
             pause: float = 0.2) -> DataFrame:
    """Fetch the latest annual report of each company that has none stored; ``cik, error`` of those that failed.

    Index and filing are each written before they are used, so nothing is
    fetched twice, and a later run finds the filings.
    """
    fetch = fetch or fetch_text
    have = stored_filings(spark, data_dir, ciks).select("cik").distinct()
    todo = ciks.select("cik").distinct().join(have, "cik", "left_anti")
    urls = todo.select(F.col("cik").alias("key"), edgar.submissions_url(F.col("cik")).alias("url"))
    answers = pin(fetch_all(urls, options, fetch, pause=pause), "indexes")
    indexes = parse_submissions(answers.where("body IS NOT NULL").select(F.col("key").alias("cik"), F.col("body").alias("submissions")))
    latest = pin(latest_filing(indexes.drop("submissions")).select("cik", "url", "file_name"), "latest")
    pages = fetch_all(latest.where("url IS NOT NULL").select(F.col("cik").alias("key"), "url"), options, fetch, pause=pause)
    pages = pin(pages.withColumnRenamed("key", "cik"), "pages")
    filings = pages.where("body IS NOT NULL").join(latest.select("cik", "file_name"), "cik")
    filings.select("cik", F.col("file_name").alias("file"), F.col("body").alias("html")).write.mode("append").parquet(_downloads(data_dir))
    return (answers.where("body IS NULL").select(F.col("key").alias("cik"), "error")
            .unionByName(latest.where("url IS NULL").select("cik", F.lit("no annual report in the index").alias("error")))
            .unionByName(pages.where("body IS NULL").select("cik", "error")))


def any_path(spark: SparkSession, pattern: str) -> bool:
    target, fs = _hadoop_path(spark, pattern)
    return bool(fs.globStatus(target))


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _hadoop_path(spark, path)
    return fs.exists(target)


def cached_filing(spark: SparkSession, data_dir: str, cik: str) -> str | None:
    """First stored filing of a company, looked up by the number as it was given."""
    target, fs = _hadoop_path(spark, f"{data_dir.rstrip('/')}/10k_{cik}_*.htm*")
    hits = fs.globStatus(target)
    names = sorted(str(h.getPath()) for h in hits) if hits is not None else []
    return names[0] if names else None


def fetch_text(url: str, user_agent: str, timeout: float = 60.0) -> str:
    request = urllib.request.Request(url, headers={"User-Agent": user_agent})
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        return answer.read().decode("utf-8", errors="replace")


FETCHED = T.StructType([T.StructField("key", T.StringType()), T.StructField("body", T.StringType()),
                        T.StructField("error", T.StringType())])


def fetch_all(urls: DataFrame, options: Options = Options(), fetch=fetch_text, parallel: int = 2,
              pause: float = 0.2) -> DataFrame:
    """Download every ``url`` of ``(key, url)`` rows; failures come back as an error text.

    ``parallel`` tasks with ``pause`` seconds between requests stay below the
    server's limit of ten requests per second.
    """
    agent = options.user_agent

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, url in zip(batch["key"], batch["url"]):
                body, error = None, None
                try:
                    time.sleep(pause)
                    body = fetch(url, agent)
                except Exception as failure:
                    error = str(failure)
                yield pd.DataFrame([(key, body, error)], columns=["key", "body", "error"])

    return urls.select("key", "url").repartition(parallel).mapInPandas(run, FETCHED)
