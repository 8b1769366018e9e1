"""Naming an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Spark may copy an expression to each place that uses it, also into a
    lambda that runs once per array element. A one-element transform keeps
    the value in a lambda variable instead.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
