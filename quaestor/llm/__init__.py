"""Operators for preparing training data, and their registered queries."""

from __future__ import annotations

from importlib import import_module

MODULES = ("toxicity", "simhash", "line_dedup", "url_rules", "decontaminate", "mixing", "quality", "langid", "html_text", "lm", "suffix_dedup", "negatives", "collocations")

QUERIES = {k: v for m in MODULES for k, v in import_module(f"quaestor.llm.{m}").QUERIES.items()}
ORACLE = {k: v for m in MODULES for k, v in import_module(f"quaestor.llm.{m}").ORACLE.items()}
