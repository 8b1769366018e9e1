"""Bounded labelled samples and small models fitted with numpy."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from quaestor.llm.tables import pin

_HASHES = float(1 << 64)


def bounded_sample(rows: DataFrame, label: str, cap: int) -> DataFrame:
    """About ``cap`` rows of each label at most, the same ones in each run.

    Rows are counted per label and kept below a threshold on the hash of their
    ``doc_id``; labels with no more than ``cap`` rows keep all. The labels
    themselves have to be few, as those of a classifier are.
    """
    counts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    limit = reduce(lambda c, v: F.when(F.col(label) == v, F.lit(min(1.0, cap / counts[v]))).otherwise(c), counts, F.lit(0.0))
    place = (F.xxhash64(F.lit(77), "doc_id").cast("double") + _HASHES / 2) / _HASHES
    return rows.where(place <= limit)


def one_text(rows: DataFrame, label: str) -> DataFrame:
    """``doc_id, label, text``: of the rows of each id and label the one whose text has the smallest hash."""
    least = rows.groupBy("doc_id", label).agg(F.min(F.struct(F.xxhash64("text").alias("place"), "text")).alias("least"))
    return least.select("doc_id", label, F.col("least.text").alias("text"))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, cap: int, learn: Column | None = None) -> DataFrame:
    """Pinned ``doc_id, text, label`` of a bounded sample of ``labels(doc_id, label)``; values 0 and 1 only.

    The sample is bounded by ``cap`` per label, which is why it is broadcast
    to the scan of the texts. Of rows that repeat an id, one stands for all, so
    the bound holds for rows, too.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.select("doc_id", F.col(label).cast("int").alias("label"))
    chosen = pin(bounded_sample(known if learn is None else known.where(learn), "label", cap).distinct(), "labels")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return pin(one_text(rows, "label").select("doc_id", "text", "label"), "labelled")


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: float, steps: int = 50) -> np.ndarray:
    """Weights (bias last) of a logistic regression drawn to ``prior`` by a ridge, by damped Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = prior.astype(float).copy()
    ridge = np.full(len(w), strength)
    ridge[-1] = 1e-3

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float(np.sum(np.logaddexp(0, z) - y * z) + np.sum(ridge * (v - prior) ** 2) / 2)
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (p - y) + ridge * (w - prior)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(ridge), gradient)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(np.asarray(z, float) / 2))
