"""Quality rules: plain limits on counts, and a calibrated logistic regression on hashed n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from quaestor.llm.tables import free_name, read_table
from quaestor.llm.training import fit_logistic, labelled_texts, sigmoid
from quaestor.llm.words import NO_SPACE, Piece, find_words, hash_spans, mix, pieces

LABELLED_CAP = 1000  # labelled rows of each class that are learned from
BUCKETS = 1 << 12  # of words and word pairs, and again of characters
CHAR_GRAMS = (3, 4)
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_QUALITY = 0.5
STEPS, RATE, RIDGE = 150, 0.05, 1e-3

_LEAD = (np.arange(256) & 0xC0) != 0x80
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _sums(values: np.ndarray, piece: Piece) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)))
    return total[piece.offsets[1:]] - total[piece.offsets[:-1]]


def _same_as_before(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort order by text and hash, and which sorted places equal the one before."""
    order = np.lexsort((h, doc))
    same = np.zeros(len(h), bool)
    same[1:] = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    return order, same


def _pair_hash(words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = words.doc[1:] == words.doc[:-1]
    return words.doc[1:][inside], mix(h[:-1] * np.uint64(3) + h[1:])[inside]


def _char_grams(piece: Piece, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts and buckets of all runs of ``size`` bytes."""
    n = len(piece.data) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.zeros(n, np.uint32)
    for k in range(size):
        code |= piece.data[k:k + n].astype(np.uint32) << np.uint32(8 * k)
    bucket = (code * np.uint32(0x9E3779B1) + np.uint32(size * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(20)
    doc = np.repeat(np.arange(piece.count), np.diff(piece.offsets))[:n]
    inside = np.arange(n) + size <= piece.offsets[doc + 1]
    return doc[inside], bucket[inside].astype(np.int64)


def counts_of(piece: Piece, words, h: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text of a piece; ``h`` are the hashes of its words."""
    n = piece.count
    inside = NO_SPACE[piece.data]
    out = {"n_words": np.bincount(words.doc, minlength=n), "word_chars": _sums(inside & _LEAD[piece.data], piece),
           "n_symbols": _sums(_SYMBOL[piece.data], piece)}
    lines = find_words(piece, piece.data != 10)
    held = np.concatenate(([0], np.cumsum(inside)))
    some = held[lines.end] > held[lines.start]
    doc = lines.doc[some]
    order, same = _same_as_before(doc, hash_spans(piece.data, lines.start, lines.end)[some])
    out["n_dup_lines"] = np.bincount(doc[order[same]], minlength=n)
    repeated = np.zeros(len(h) + 1, np.int64)
    w = len(h) - REPEAT_WINDOW + 1
    if w > 0:
        window = np.zeros(w, np.uint64)
        for k in range(REPEAT_WINDOW):
            window = window * np.uint64(0xD1342543DE82EF95) + h[k:k + w]
        start = np.flatnonzero(words.doc[:w] == words.doc[REPEAT_WINDOW - 1:])
        order, same = _same_as_before(words.doc[start], mix(window)[start])
        twice = same.copy()
        twice[:-1] |= same[1:]
        hit = start[order[twice]]
        np.add.at(repeated, hit, 1)
        np.add.at(repeated, hit + REPEAT_WINDOW, -1)
    out["n_repeat_words"] = np.bincount(words.doc[np.cumsum(repeated)[:-1] > 0], minlength=n)
    return out


@dataclass
class QualityModel:
    """Weights per bucket for the mean over a text's word grams and over its character grams, calibrated."""
    words: np.ndarray
    chars: np.ndarray
    bias: float

    def probability(self, piece: Piece, words, h: np.ndarray) -> np.ndarray:
        n = piece.count
        total, number = np.zeros(n), np.zeros(n)
        for doc, grams in ((words.doc, h), _pair_hash(words, h)):
            total += np.bincount(doc, self.words[(grams & np.uint64(BUCKETS - 1)).astype(np.int64)], minlength=n)
            number += np.bincount(doc, minlength=n)
        margin = total / np.maximum(number, 1)
        total, number = np.zeros(n), np.zeros(n)
        for size in CHAR_GRAMS:
            doc, bucket = _char_grams(piece, size)
            total += np.bincount(doc, self.chars[bucket], minlength=n)
            number += np.bincount(doc, minlength=n)
        return sigmoid(margin + total / np.maximum(number, 1) + self.bias)


def _histogram(piece: Piece) -> np.ndarray:
    words = find_words(piece)
    h = hash_spans(piece.data, words.start, words.end)
    out = np.zeros((piece.count, 2 * BUCKETS), np.float32)
    for doc, grams in ((words.doc, h), _pair_hash(words, h)):
        np.add.at(out, (doc, (grams & np.uint64(BUCKETS - 1)).astype(np.int64)), 1)
    for size in CHAR_GRAMS:
        doc, bucket = _char_grams(piece, size)
        np.add.at(out, (doc, bucket + BUCKETS), 1)
    for part in (out[:, :BUCKETS], out[:, BUCKETS:]):
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1)
    return out


def _histograms(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([row.astype(np.float16).tobytes() for piece in pieces(batch, 1 << 16) for row in _histogram(piece)], pa.binary())


def train(docs: DataFrame, labels: DataFrame, cap: int = LABELLED_CAP) -> QualityModel | None:
    """A model of ``labels.quality`` from at most about ``cap`` rows of each class; None without both classes.

    Four fifths of the sample fit the weights, the rest scales the margin to
    probabilities.
    """
    sample = labelled_texts(docs, labels, "quality", cap).select("label", "doc_id", arrow_udf(_histograms, BinaryType())("text").alias("x"))
    rows = sample.toPandas().sort_values("doc_id", kind="stable")
    if rows["label"].nunique() < 2:
        return None
    x = np.stack([np.frombuffer(b, np.float16) for b in rows["x"]]).astype(np.float32)
    y = rows["label"].to_numpy(np.float32)
    del rows
    scale = 1 / np.sqrt(x.mean(axis=0) + 1e-6)
    x *= scale
    balance = np.where(y == 1, len(y) / (2 * max(y.sum(), 1)), len(y) / (2 * max((1 - y).sum(), 1))).astype(np.float32)
    held = np.arange(len(y)) % 5 == 4
    fit, w, bias = ~held, np.zeros(x.shape[1], np.float32), 0.0
    xf, yf, bf = x[fit], y[fit], balance[fit]
    m, v = np.zeros(len(w) + 1, np.float32), np.zeros(len(w) + 1, np.float32)
    for step in range(1, STEPS + 1):
        error = (sigmoid(xf @ w + bias).astype(np.float32) - yf) * bf / len(yf)
        g = np.append(xf.T @ error + RIDGE * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w, bias = w - move[:-1], bias - float(move[-1])
    margin = (x @ w + bias)[held]
    if len(set(y[held])) == 2:
        slope, shift = fit_logistic(margin[:, None].astype(float), y[held].astype(float), np.array([1.0, 0.0]), 1.0)
    else:
        slope, shift = 1.0, 0.0
    w = (w * scale * slope).astype(np.float64)
    return QualityModel(w[:BUCKETS], w[BUCKETS:], float(bias * slope + shift))


RESULT = StructType([*[StructField(c, LongType()) for c in COUNTS], StructField("quality", DoubleType())])


def measure(text: Column, model: QualityModel | None) -> Column:
    """Struct of the base counts and the probability of good quality (1 without a model); null counts as empty."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = []
            for piece in pieces(batch):
                words = find_words(piece)
                h = hash_spans(piece.data, words.start, words.end)
                row = counts_of(piece, words, h)
                row["quality"] = np.ones(piece.count) if model is None else model.probability(piece, words, h)
                parts.append(row)
            columns = [pa.array(np.concatenate([p[c] for p in parts]) if parts else [], pa.float64() if c == "quality" else pa.int64())
                       for c in (*COUNTS, "quality")]
            yield pa.StructArray.from_arrays(columns, [*COUNTS, "quality"])
    return arrow_udf(run, RESULT)(text)


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with a struct ``quality_rules``: the counts, ``quality``, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 20 words, or more than 30 % of them in
    repeated 8-word windows. ``kept`` also needs a quality of at least 0.5.
    Rows are judged alone, so repeated rows and ids change nothing.
    """
    name = free_name(docs, "quality_rules")
    rows = docs.withColumn(name, measure(F.col("text"), train(docs, labels)))
    failed = (F.col(f"{name}.n_words") < MIN_WORDS) | (
        100 * F.col(f"{name}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{name}.n_words"))
    return rows.withColumn(name, F.struct(f"{name}.*", failed.alias("base_failed"),
                                          (~failed & (F.col(f"{name}.quality") >= MIN_QUALITY)).alias("kept")))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_quality(docs, read_table(spark, sf_dir, "labels")).select("doc_id", "quality_rules.*")


QUERIES = {"op8_quality": op8_quality}
ORACLE: dict[str, str] = {}
