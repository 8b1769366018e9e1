from __future__ import annotations

import numpy as np
import pyarrow as pa

from quaestor.llm.langid import BUCKETS, RIDGE, fit, op9_langid, presence, train
from quaestor.llm.langid import identify
from quaestor.llm.tables import read_table
from quaestor.llm.words import pieces
from pyspark.sql import functions as F
from tests.conftest import SF_DIR


def seen_in(texts):
    return np.vstack([m for p in pieces(pa.array(texts)) for _, m in presence(p)])


def test_presence_matches_sets_of_grams():
    def grams(text):
        raw = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in text.lower().encode())
        return {(n, raw[i:i + n]) for n in (1, 2, 3, 4) for i in range(len(raw) - n + 1)}
    texts = ["abc", "ABC", "", "a,b!c", "é", "xy" * 5]
    got = seen_in(texts)
    assert got.shape == (len(texts), BUCKETS)
    assert (got[0] == got[1]).all()
    assert [int(r.sum()) for r in got] == [len(grams(t)) for t in texts]


def test_folded_weights_equal_the_kernel_machine():
    texts = ["the cat and the dog", "the house of the man", "le chat et la maison", "la rue et le jardin", "the and of", "le et la"]
    langs = ["en", "en", "fr", "fr", "en", "fr"]
    seen = seen_in(texts)
    model = fit(seen, langs, landmarks=4)
    unit = seen / np.sqrt(seen.sum(axis=1, keepdims=True))
    kernel = unit @ unit.T
    marks = [0, 2, 1, 3]
    values, vectors = np.linalg.eigh(kernel[np.ix_(marks, marks)])
    z = kernel[:, marks] @ (vectors / np.sqrt(values))
    y = np.array([[1.0 if x == n else -1.0 for n in ("en", "fr")] for x in langs])
    beta = np.linalg.solve(z.T @ z + RIDGE * np.eye(4), z.T @ y)
    assert np.allclose(model.outputs(seen), z @ beta, atol=1e-3)


def test_query_on_held_out_rows(spark):
    docs = {r.doc_id: r for r in read_table(spark, SF_DIR, "documents").collect()}
    got = op9_langid(spark, SF_DIR).collect()
    held = [r.lang_pred == docs[r.doc_id].lang for r in got if r.held_out and docs[r.doc_id].lang]
    assert len(got) == len(docs) and sum(held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_rows(spark):
    rows = [(1, "the cat", "en"), (2, "le chat", "fr"), (None, "the", "en"), (3, None, "fr"), (3, "12 .,", None), (4, "", "en"), (5, "ж", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train(docs)
    got = docs.select("text", identify(F.col("text"), model).alias("f")).collect()
    assert {r.text: r.f.lang_pred for r in got if r.text in (None, "", "12 .,", "the cat", "le chat")} == {
        None: "und", "": "und", "12 .,": "und", "the cat": "en", "le chat": "fr"}
    assert [r.f.lang_pred for r in got if r.text == "ж"][0] in ("en", "fr")
    assert train(docs.limit(0)) is None
    assert docs.select(identify(F.col("text"), None).alias("f")).where("f.lang_pred = 'und'").count() == len(rows)
