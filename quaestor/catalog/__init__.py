"""All registered queries and their oracle SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("scoring", "dataset", "texts", "borders", "similarity", "sources")


def all_queries():
    return {k: v for m in MODULES for k, v in import_module(f"quaestor.catalog.{m}").QUERIES.items()}


def all_oracles():
    return {k: v for m in MODULES for k, v in import_module(f"quaestor.catalog.{m}").ORACLE.items()}
