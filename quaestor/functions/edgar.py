"""Names and addresses of filings as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def pad_cik(cik: Column) -> Column:
    """Ten digits with leading zeros; longer numbers stay as they are."""
    bare = F.ltrim(cik, F.lit("0"))
    return F.when(F.length(bare) >= 10, bare).otherwise(F.lpad(bare, 10, "0"))


def submissions_url(cik: Column) -> Column:
    return F.concat(F.lit("https://data.sec.gov/submissions/CIK"), pad_cik(cik), F.lit(".json"))


def filing_url(cik: Column, accession: Column, document: Column) -> Column:
    return F.concat(F.lit("https://www.sec.gov/Archives/edgar/data/"), pad_cik(cik), F.lit("/"),
                    F.replace(accession, F.lit("-"), F.lit("")), F.lit("/"), document)


def cache_filename(cik: Column, accession: Column, url: Column) -> Column:
    """Local name of a filing; the company number is used as it was given."""
    ending = F.when(F.endswith(url, F.lit(".htm")), ".htm").otherwise(".html")
    return F.concat(F.lit("10k_"), cik, F.lit("_"), accession, ending)


def first_annual_report(recent: Column) -> Column:
    """First entry whose form is exactly 10-K, from the parallel arrays of a filing index."""
    entries = F.arrays_zip(recent["form"].alias("form"), recent["accessionNumber"].alias("accession"),
                           recent["primaryDocument"].alias("document"))
    return F.get(F.filter(entries, lambda e: e["form"] == "10-K"), F.lit(0))
