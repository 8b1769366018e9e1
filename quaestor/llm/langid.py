"""Language identification with string kernels."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType, DoubleType, StringType, StructField, StructType

from quaestor.llm.tables import held_back, pin, read_table
from quaestor.llm.training import bounded_sample, one_text
from quaestor.llm.words import Piece, folded, letters, pieces

SIZES = (1, 2, 3, 4)  # bytes in an n-gram
BUCKETS = 1 << 15
TOTAL_CAP = 8000  # texts that are learned from
LANGUAGE_CAP = 400
LANDMARKS = 256
RIDGE = 1e-2
SHARPNESS = 6.0
TEXTS = 256  # texts in one matrix
HOLD_PARTS = 3
UNKNOWN = "und"


def presence(piece: Piece) -> Iterator[tuple[int, np.ndarray]]:
    """First text and 0/1 matrix (text, bucket) of the n-grams that each text holds, for groups of texts.

    Capitals are folded, everything but letters counts as a space.
    """
    data = np.where(letters(piece.data), folded(piece.data), np.uint8(32)) if len(piece.data) else piece.data
    for first in range(0, piece.count, TEXTS):
        offsets = piece.offsets[first:first + TEXTS + 1]
        part, offsets = data[offsets[0]:offsets[-1]].astype(np.uint32), offsets - offsets[0]
        rows = len(offsets) - 1
        doc = np.repeat(np.arange(rows), np.diff(offsets))
        left = offsets[doc + 1] - np.arange(len(part))  # bytes up to the text's end
        seen = np.zeros(rows * BUCKETS, np.uint8)
        code = np.zeros(len(part), np.uint32)
        for size in SIZES:
            code = code[:len(part) - size + 1] | part[size - 1:] << np.uint32(8 * (size - 1))
            inside = left[:len(code)] >= size
            bucket = (code * np.uint32(0x9E3779B1) + np.uint32(size * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(17)
            seen[doc[:len(code)][inside] * BUCKETS + bucket[inside]] = 1
        yield piece.first + first, seen.reshape(rows, BUCKETS)


@dataclass
class LanguageModel:
    """One weight per bucket and language.

    The kernel is linear in the presence vectors, so the map onto the
    landmarks and the ridge weights fold into this one matrix.
    """
    languages: list[str]
    weights: np.ndarray

    def outputs(self, seen: np.ndarray) -> np.ndarray:
        size = np.sqrt(np.maximum(seen.sum(axis=1, dtype=np.int64), 1))
        return seen.astype(np.float32) @ self.weights / size[:, None]


def fit(seen: np.ndarray, languages: list[str], landmarks: int = LANDMARKS) -> LanguageModel:
    """One-versus-rest kernel ridge regression on Nystrom features of the normalised presence kernel.

    The first texts of each language in turn are the landmarks.
    """
    names = sorted(set(languages))
    target = np.array([[1.0 if x == n else -1.0 for n in names] for x in languages])
    turn = np.zeros(len(languages), int)
    for n in names:
        mine = [k for k, x in enumerate(languages) if x == n]
        turn[mine] = range(len(mine))
    chosen = np.lexsort((np.arange(len(turn)), turn))[:landmarks]
    size = np.sqrt(np.maximum(seen.sum(axis=1, dtype=np.int64), 1))
    marks = (seen[chosen] / size[chosen][:, None]).astype(np.float32)
    kernel = np.vstack([(seen[k:k + TEXTS].astype(np.float32) @ marks.T) / size[k:k + TEXTS][:, None]
                        for k in range(0, len(seen), TEXTS)]).astype(float)
    values, vectors = np.linalg.eigh(kernel[chosen])
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    z = kernel @ root
    weight = 1 / (target > 0).sum(axis=0)[np.argmax(target, axis=1)]
    zw = z * (weight * len(weight) / weight.sum())[:, None]
    beta = np.linalg.solve(z.T @ zw + RIDGE * np.eye(z.shape[1]), zw.T @ target)
    return LanguageModel(names, (marks.T.astype(float) @ (root @ beta)).astype(np.float32))


def _packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([np.packbits(row).tobytes() for piece in pieces(batch) for _, seen in presence(piece) for row in seen], pa.binary())


def train(docs: DataFrame, learn: Column | None = None) -> LanguageModel | None:
    """A model from about ``LANGUAGE_CAP`` texts per language (fewer of each if they'd be over ``TOTAL_CAP``).

    None if no row has both a text and a language.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    rows = (rows if learn is None else rows.where(learn)).select("doc_id", "lang")
    number = rows.select("lang").distinct().count()
    ids = pin(bounded_sample(rows, "lang", min(LANGUAGE_CAP, max(TOTAL_CAP // max(number, 1), 1))).distinct(), "langid-sample")
    texts = docs.select("doc_id", "text", F.col("lang").alias("own")).where(F.col("text").isNotNull())
    sample = one_text(texts.join(F.broadcast(ids), "doc_id").where(F.col("own") == F.col("lang")), "lang")
    found = sample.select("doc_id", "lang", arrow_udf(_packed, BinaryType())("text").alias("bits")).toPandas()
    if not len(found):
        return None
    found = found.sort_values(["doc_id", "bits"], kind="stable")
    bits = np.stack([np.frombuffer(b, np.uint8) for b in found["bits"]])
    return fit(np.unpackbits(bits, axis=1), found["lang"].tolist())


RESULT = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])
_ASCII_LETTERS = np.zeros(256, bool)
_ASCII_LETTERS[[*range(65, 91), *range(97, 123)]] = True


def identify(text: Column, model: LanguageModel | None) -> Column:
    """Struct of the likeliest language and its share among all; ``und`` and 0 for null and for texts without a letter."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names: list[str] = [UNKNOWN] * len(batch)
            shares = np.zeros(len(batch))
            for piece in pieces(batch) if model else ():
                found = np.concatenate(([0], np.cumsum(_ASCII_LETTERS[piece.data])))
                plain = found[piece.offsets[1:]] > found[piece.offsets[:-1]]
                for first, seen in presence(piece):
                    outputs = model.outputs(seen) * SHARPNESS
                    outputs = np.exp(outputs - outputs.max(axis=1, keepdims=True))
                    outputs /= outputs.sum(axis=1, keepdims=True)
                    for k, best in enumerate(outputs.argmax(axis=1)):
                        at = first + k
                        if plain[at - piece.first] or any(c.isalpha() for c in batch[at].as_py() or ""):
                            names[at], shares[at] = model.languages[best], outputs[k, best]
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(shares)], ["lang_pred", "score"])
    return arrow_udf(run, RESULT)(text)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = held_back(F.col("doc_id"), HOLD_PARTS)
    model = train(docs, held != 1)
    rows = docs.select("doc_id", F.coalesce(held == 1, F.lit(False)).alias("held_out"), identify(F.col("text"), model).alias("found"))
    return rows.select("doc_id", "held_out", "found.*")


QUERIES = {"op9_langid": op9_langid}
ORACLE: dict[str, str] = {}
