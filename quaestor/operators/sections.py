"""Cutting the flat text of a filing into its named sections.

All work on one filing happens inside its row: header positions, cuts,
cleaning and the fallback are array expressions, so the step needs no
shuffle and filings spread over the cluster as they were read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quaestor.functions import text as tx

# Header pattern of every section that is cut out. A header of
# "Item 1B: Unresolved Staff Comments" is known as well, but it neither opens
# a section nor ends one.
SECTION_PATTERNS = (
    (r"item\s*1a[.\s:]*risk\s*factors", "Item 1A: Risk Factors"),
    (r"item\s*1[.\s:]*business", "Item 1: Business"),
    (r"item\s*7a[.\s:]*quantitative", "Item 7A: Market Risk Disclosures"),
    (r"item\s*7[.\s:]*management", "Item 7: MD&A"),
    (r"item\s*8[.\s:]*financial\s*statements", "Item 8: Financial Statements"),
)
UNRESOLVED_PATTERN = (r"item\s*1b[.\s:]*unresolved\s*staff", "Item 1B: Unresolved Staff Comments")

SECTION_NAMES = tuple(name for _, name in SECTION_PATTERNS)

FALLBACK_PARTS = 5


def _java(pattern: str) -> str:
    """Spell out Unicode whitespace, which Java's ``\\s`` does not cover."""
    return pattern.replace(r"[.\s:]", f"[.:{tx.SPACE}]").replace(r"\s", f"[{tx.SPACE}]")


def last_hit(text: Column, pattern: str) -> Column:
    """Zero-based position of the last hit, NULL without one.

    A greedy prefix ends where the last hit begins.
    """
    pattern = _java(pattern)
    prefix = F.regexp_extract(text, rf"(?ius)\A(.*)(?:{pattern})", 1)
    return F.when(F.regexp_like(text, F.lit(rf"(?iu){pattern}")), F.length(prefix))


def section_markers(filings: DataFrame) -> DataFrame:
    """One row per filing and detected section: number of hits and position of the last one."""
    hits = [F.struct(F.lit(name).alias("section"),
                     F.regexp_count("full_text", F.lit(rf"(?iu){_java(pattern)}")).alias("hits"),
                     last_hit(F.col("full_text"), pattern).alias("start_pos"))
            for pattern, name in (*SECTION_PATTERNS, UNRESOLVED_PATTERN)]
    return (filings.select("doc_id", F.inline(F.array(*hits)))
            .where(F.col("start_pos").isNotNull()))


def fallback_slices(text: Column) -> Column:
    """Five slices of equal length; the last one takes the remainder."""
    size = F.floor(F.length(text) / FALLBACK_PARTS).cast("int")

    def piece(i: Column) -> Column:
        start = i * size
        length = F.when(i < FALLBACK_PARTS - 1, size).otherwise(F.length(text) - start)
        return F.struct(F.concat(F.lit("Section "), (i + 1).cast("string")).alias("section"),
                        start.alias("start_pos"),
                        F.substring(text, start + 1, length).alias("full_text"))

    return F.transform(F.sequence(F.lit(0), F.lit(FALLBACK_PARTS - 1)), piece)


def fallback_split(filings: DataFrame) -> DataFrame:
    cleaned = filings.select("doc_id", tx.clean_text(F.col("full_text")).alias("_clean"))
    return cleaned.select("doc_id", F.inline(fallback_slices(F.col("_clean"))))


def split_sections(filings: DataFrame, min_chars: int = 500) -> DataFrame:
    """Cleaned sections of every filing, cut from the last header of each section.

    A section runs to the next header or the end of the text and is kept when
    its cleaned text has more than ``min_chars`` characters. A filing without
    any such section is cut into five slices instead.
    """
    hits = F.array(*[F.struct(last_hit(F.col("full_text"), pattern).alias("start_pos"), F.lit(name).alias("section"))
                     for pattern, name in SECTION_PATTERNS])
    marked = filings.withColumn("_marks", F.sort_array(F.filter(hits, lambda h: h["start_pos"].isNotNull())))

    def cut(mark: Column, i: Column) -> Column:
        following = F.get(F.col("_marks"), i + 1)["start_pos"]
        end = F.coalesce(following, F.length("full_text"))
        raw = F.substring(F.col("full_text"), mark["start_pos"] + 1, end - mark["start_pos"])
        return F.struct(mark["section"].alias("section"), mark["start_pos"].alias("start_pos"),
                        tx.clean_text(raw).alias("full_text"))

    cuts = marked.withColumn("_cuts", F.filter(F.transform("_marks", cut),
                                               lambda s: F.length(s["full_text"]) > min_chars))
    whole = cuts.withColumn("_clean", F.when(F.size("_cuts") == 0, tx.clean_text(F.col("full_text"))))
    chosen = F.when(F.size("_cuts") > 0, F.col("_cuts")).otherwise(fallback_slices(F.col("_clean")))
    return whole.select("doc_id", F.inline(chosen))
