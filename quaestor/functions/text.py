"""Text expressions. Every function takes and returns a Column."""

from __future__ import annotations

import string
import sys
import unicodedata

from pyspark.sql import Column, functions as F

# Character classes that reproduce Python's Unicode rules in Java
# regular expressions. Java's own \w, \s and \d are ASCII-only by default.
WORD = r"\p{L}\p{N}_"
BLANK = r"\t\x0b-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = r"\n" + BLANK
PUNCTUATION = string.punctuation

# Marks of arithmetic in a reasoning text.
OPERATOR_MARKS = ("+", "-", "*", "/", "=", "%", "x", "times", "divided")

# Error texts that are worth another try, by backend.
RETRYABLE = {
    "openrouter": ("429", "500", "503", "rate_limit", "overloaded", "timeout"),
    "gemini": ("429", "500", "503", "RESOURCE_EXHAUSTED"),
}


def as_text(value: Column) -> Column:
    """A missing value reads as the word ``nan``, as it does in a pandas frame."""
    return F.coalesce(value.cast("string"), F.lit("nan"))


def strip(text: Column) -> Column:
    """Remove Unicode whitespace from both ends (``trim`` knows only the space)."""
    return F.regexp_replace(text, rf"\A[{SPACE}]+|[{SPACE}]+\z", "")


def normalized_tokens(text: Column) -> Column:
    """Lower-case words without articles and punctuation, as an array."""
    lowered = F.lower(as_text(text))
    no_articles = F.regexp_replace(lowered, rf"(?<![{WORD}])(?:a|an|the)(?![{WORD}])", " ")
    no_marks = F.translate(no_articles, PUNCTUATION, "")
    return F.filter(F.split(no_marks, f"[{SPACE}]+"), lambda t: t != "")


def normalize_text(text: Column) -> Column:
    return F.array_join(normalized_tokens(text), " ")


# Code points of the zeros whose nine successors are the other digits of their script.
ZEROS = tuple(c for c in range(128, sys.maxunicode) if unicodedata.decimal(chr(c), None) == 0)


def ascii_digits(text: Column) -> Column:
    """Decimal digits of all scripts as 0 to 9; texts without such digits are left alone."""
    digits = "".join(chr(z + k) for z in ZEROS for k in range(10))
    return F.when(text.rlike(r"[\p{Nd}&&[^0-9]]"), F.translate(text, digits, "0123456789" * len(ZEROS))).otherwise(text)


def extract_numbers(text: Column) -> Column:
    """Every unsigned number in the text as an array of doubles, in order."""
    # Fixed value: the pattern of a number; all Unicode digits count.
    found = F.regexp_extract_all(ascii_digits(as_text(text)), F.lit(r"[$]?\d+[,\d]*\.?\d*[%]?"), F.lit(0))
    parsed = F.transform(found, lambda m: F.translate(m, "$%,", "").try_cast("double"))
    return F.filter(parsed, lambda n: n.isNotNull())


def word_set(text: Column) -> Column:
    """Distinct lower-case words."""
    return F.array_distinct(F.regexp_extract_all(F.lower(as_text(text)), F.lit(f"[{WORD}]+"), F.lit(0)))


def estimate_tokens(text: Column) -> Column:
    """Four characters count as one token."""
    return F.floor(F.length(text) / F.lit(4)).cast("int")


def split_sentences(text: Column) -> Column:
    """Split behind ``.``, ``!`` or ``?`` at whitespace."""
    return F.split(text, rf"(?<=[.!?])[{SPACE}]+")


def sentence_gaps(text: Column) -> Column:
    """The whitespace runs between the pieces of :func:`split_sentences`."""
    return F.regexp_extract_all(text, F.lit(rf"(?<=[.!?])[{SPACE}]+"), F.lit(0))


def clean_text(text: Column) -> Column:
    """Collapse whitespace, drop page-number lines and table-of-contents labels."""
    text = F.regexp_replace(text, rf"\n[{SPACE}]*\n", "\n\n")
    text = F.regexp_replace(text, f"[{BLANK}]+", " ")
    # Only spaces and newlines are left as whitespace from here on.
    text = F.regexp_replace(text, r"\n[ \n]*\p{Nd}+[ \n]*\n", "\n")
    text = F.regexp_replace(text, r"(?iu)table of contents[ \n]*", "")
    text = F.regexp_replace(text, r" ?\n ?", "\n")
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    return F.regexp_replace(text, r"\A[ \n]+|[ \n]+\z", "")


def is_fake_calculation(reasoning: Column) -> Column:
    """True when a reasoning text is missing or shows no arithmetic."""
    lowered = F.lower(F.coalesce(reasoning, F.lit("")))
    shown = F.lit(False)
    for mark in OPERATOR_MARKS:
        shown = shown | F.contains(lowered, F.lit(mark))
    return ~shown


def is_fake_multi_step(passage: Column) -> Column:
    """True when a passage is missing or has at most one piece between full stops."""
    pieces = F.split(F.coalesce(passage, F.lit("")), "[.]")
    return F.size(F.filter(pieces, lambda p: F.length(strip(p)) > 5)) <= 1


def preview(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def title_label(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def percent_label(share: Column) -> Column:
    """A percentage with one decimal; exact ties, which end in .25 or .75, go to the even digit."""
    tie = (share * 4 == F.floor(share * 4)) & (share * 2 != F.floor(share * 2))
    down = tie & (F.floor(share * 10) % 2 == 0)
    return F.when(share.isNotNull(), F.format_string("%.1f%%", F.when(down, F.floor(share * 10) / 10).otherwise(share)))


def percent_bar(share: Column) -> Column:
    """One block for every full five percent."""
    return F.repeat(F.lit("█"), F.floor(share / 5).cast("int"))


def is_retryable(error: Column, backend: str) -> Column:
    hit = F.lit(False)
    for mark in RETRYABLE[backend]:
        hit = hit | F.contains(error, F.lit(mark))
    return hit


def backoff_seconds(attempt: Column, base: int = 10) -> Column:
    """Doubling wait before another try; attempts count from zero."""
    return (F.lit(base) * F.pow(F.lit(2), attempt)).cast("int")
